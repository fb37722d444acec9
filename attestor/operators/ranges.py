"""Running sums over a whole order without a window over all rows.

Rows are dealt into ranges of the order at bounds drawn from a sample of their keys.  Sums run inside each range;
the totals of the ranges, few rows, are summed in order and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a range holds about, most ranges, and sampled keys for each.
ROWS, MOST, SAMPLED = 250_000, 2048, 16


def bounds(df: DataFrame, key: str, rows: int = ROWS, most: int = MOST) -> DataFrame:
    """One row: ``_heads`` and ``_blocks``, ascending bounds of about ``rows`` rows each, in blocks for two short scans."""
    size, sample = df.agg(F.count(F.lit(1)).alias("_size")), most * SAMPLED
    h = F.xxhash64(key)
    few = df.select(key).crossJoin(F.broadcast(size)).where(F.pmod(h, F.lit(1 << 30)) <= (1 << 30) * F.least(F.lit(1.0), 2 * sample / F.col("_size")))  # one row
    drawn = few.orderBy(h, key).limit(sample).agg(F.array_sort(F.collect_list(key)).alias("_drawn"))
    ranges = F.least(F.lit(most), F.ceil(F.col("_size") / rows), F.size("_drawn"))
    picked = F.when(ranges > 1, F.transform(F.sequence(F.lit(1), ranges - 1), lambda i: F.get("_drawn", F.floor(i * F.size("_drawn") / ranges).cast("int")))).otherwise(F.slice("_drawn", 1, 0))
    one = size.crossJoin(drawn).select(F.array_distinct(picked).alias("_all"))
    step = F.greatest(F.lit(1), F.floor(F.sqrt(F.size("_all"))).cast("int"))
    blocks = F.when(F.size("_all") > 0, F.transform(F.sequence(F.lit(1), F.size("_all"), step), lambda i: F.slice("_all", i, step))).otherwise(F.slice(F.array("_all"), 1, 0))
    return one.select(blocks.alias("_blocks")).select("_blocks", F.transform("_blocks", lambda b: b[0]).alias("_heads"))


def ranged(df: DataFrame, key: str, rows: int = ROWS, most: int = MOST) -> DataFrame:
    """Add ``_range``: how many bounds the key reaches, written as a pair of block and place."""
    found = F.size(F.filter("_heads", lambda h: h <= F.col(key)))
    inside = F.size(F.filter(F.get("_blocks", found - 1), lambda b: b <= F.col(key)))
    place = F.when(found > 0, F.struct(found.alias("block"), inside.alias("place"))).otherwise(F.struct(F.lit(0).alias("block"), F.lit(0).alias("place")))
    return df.crossJoin(F.broadcast(bounds(df, key, rows, most))).withColumn("_range", place).drop("_heads", "_blocks")  # one row


def running(df: DataFrame, order: Sequence[Column], sums: dict[str, Column], by: Sequence[str] = (), rows: int = ROWS, most: int = MOST) -> DataFrame:
    """Add to each row, for each of ``sums``, its sum up to and with the row in ascending ``order``, within ``by``.

    Rows of equal order follow one another as they come; nulls are first.  Each name also gets ``<name>_all``, the
    sum over all rows of ``by``.
    """
    key = F.struct(*[F.col(b).alias(f"b{i}") for i, b in enumerate(by)], *[o.alias(f"o{i}") for i, o in enumerate(order)])
    keyed = ranged(df.withColumns({"_key": key, **{f"_v_{n}": v for n, v in sums.items()}}), "_key", rows, most)
    same = F.struct(*[F.col(b).alias(f"b{i}") for i, b in enumerate(by)], F.lit(0).alias("one"))
    totals = keyed.groupBy(same.alias("_same"), "_range").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    whole = Window.partitionBy("_same")  # a row a range
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_same", "_range", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums], *[F.sum(f"_t_{n}").over(whole).alias(f"{n}_all") for n in sums])
    inside = Window.partitionBy("_same", "_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    local = keyed.withColumn("_same", same).withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(inside) for n in sums})
    out = local.join(totals, ["_same", "_range"])
    return out.select(*[c for c in df.columns if c not in sums], *[(F.col(f"_b_{n}") + F.col(f"_l_{n}")).alias(n) for n in sums], *[f"{n}_all" for n in sums])
