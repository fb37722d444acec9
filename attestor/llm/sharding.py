"""Sharding by sampled splitters (DataFrame functions only).

A size-weighted sample of record keys gives quantile boundaries; records are range-partitioned by
them; ranges that turn out overfull are sampled again and subdivided.  Exact sums over the ranges
then place every record on a line as long as all bytes, which is cut into equal shards.

The key is (hash of the grouping value, hash of the record), so records of equal value lie side by
side and share a shard, unless they alone exceed a quarter of one: such a hot group is cut by the
second hash like any other stretch.  No boundary cuts a group that is to stay whole: the exact totals of
the groups that sampled boundaries cut (as many at most as boundaries) are taken first.

Nulls: a null text has no bytes and counts ``overhead`` alone; null keys hash like any value.
Repeated rows are placed one by one.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestor.llm.ranges import LOWEST, MAX_RANGES, long_literal, offsets, range_count, unit_interval
from attestor.llm.scratch import materialize

#: Bytes that a record costs besides its text.
OVERHEAD = 8
#: Expected number of sampled keys, whatever the size of the table.
SAMPLE = 20_000
#: A range is overfull beyond this many times the mean.
OVERFULL = 2.0
#: Groups of at most this share of a shard stay whole.
WHOLE_GROUP = 0.25


@dataclass
class ShardPlan:
    """What ``assign`` needs: boundaries as (k1, k2) pairs, and two small tables."""

    n_shards: int
    total: int
    bounds: list[tuple[int, int]]
    ranges: DataFrame
    firsts: DataFrame = field(default=None)


def keyed(df: DataFrame, size: Column, group: Column, record: list[str]) -> DataFrame:
    """Add ``_size``, ``_k1`` and ``_k2``."""
    return df.withColumns(
        {"_size": size.cast("long"), "_k1": F.xxhash64(group), "_k2": F.xxhash64(F.lit(7), *[F.col(c) for c in record])}
    )


def _range_of(bounds: list[tuple[int, int]]) -> Column:
    """Number of boundaries at most (k1, k2), by a coarse and a fine scan."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    pair = lambda b: f"named_struct('a', {long_literal(b[0])}, 'b', {long_literal(b[1])})"
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    key = F.struct(F.col("_k1").alias("a"), F.col("_k2").alias("b"))
    heads = F.expr(f"array({', '.join(pair(b[0]) for b in blocks)})")
    table = F.expr(f"array({', '.join('array(' + ', '.join(map(pair, b)) + ')' for b in blocks)})")
    block = F.size(F.filter(heads, lambda x: x <= key))
    inside = F.size(F.filter(F.get(table, block - 1), lambda x: x <= key))
    return F.when(block <= 0, 0).otherwise((block - 1) * step + inside).cast("int")


def _quantiles(rows: list, n: int) -> list[tuple[int, int]]:
    """n - 1 boundaries that cut the sampled weight evenly."""
    rows = sorted((r._k1, r._k2, r.w) for r in rows)
    total, seen, out = sum(r[2] for r in rows), 0.0, []
    for k1, k2, w in rows:
        if seen * n >= total * (len(out) + 1) and len(out) < n - 1:
            out.append((k1, k2))
        seen += w
    # A boundary inside a group moves to the group's start, unless the group spans several ranges.
    return sorted({(k1, k2 if i and out[i - 1][0] == k1 else LOWEST) for i, (k1, k2) in enumerate(out)})


def _sample(slim: DataFrame, total: int, seed: int) -> list:
    """Keys drawn with a chance in proportion to their size; bounded by SAMPLE in expectation."""
    rate = SAMPLE / max(total, 1)
    weight = F.greatest(F.col("_size").cast("double"), F.lit(1 / rate)).alias("w")
    return slim.where(unit_interval(F.lit(seed), "_k1", "_k2") < F.col("_size") * rate).select("_k1", "_k2", weight).collect()


def _uncut(slim: DataFrame, bounds: list[tuple[int, int]], most: float) -> list[tuple[int, int]]:
    """The boundaries without those inside groups of at most ``most`` bytes; such a group's start stays one."""
    cut = sorted({k1 for k1, k2 in bounds if k2 != LOWEST})
    if not cut:
        return bounds
    sizes = slim.where(F.col("_k1").isin(cut)).groupBy("_k1").agg(F.sum("_size").alias("b"))  # at most one a boundary
    whole = {r._k1 for r in sizes.where(F.col("b") <= most).collect()}
    return sorted({(k1, LOWEST if k1 in whole else k2) for k1, k2 in bounds})


def shard_plan(slim: DataFrame, n_shards: int, n_ranges: int | None = None) -> ShardPlan:
    """Boundaries, range totals and first ranks, from the columns _size, _k1 and _k2 alone."""
    total = slim.agg(F.sum("_size")).first()[0] or 0
    n = min(MAX_RANGES, n_ranges or range_count(slim, 8 * n_shards))
    bounds = _quantiles(_sample(slim, total, 1), n)
    sums = {"bytes": "_size", "rows": ""}
    for seed in (2, 3):
        sized = slim.select(_range_of(bounds).alias("_range"), "_size", "_k1", "_k2")
        heavy = sized.groupBy("_range").agg(F.sum("_size").alias("b")).where(F.col("b") > OVERFULL * total / n).collect()
        if not heavy or len(bounds) >= MAX_RANGES:
            break
        over = sized.where(F.col("_range").isin([r._range for r in heavy]))
        more = _quantiles(_sample(over, sum(r.b for r in heavy), seed), 4 * len(heavy) + 1)
        bounds = sorted({*bounds, *more})
    bounds = _uncut(slim, bounds, WHOLE_GROUP * total / n_shards)
    ranges = offsets(slim.select(_range_of(bounds).alias("_range"), "_size"), [], ["_range"], sums)
    plan = ShardPlan(n_shards, total, bounds, ranges)
    plan.firsts = _ranked(slim, plan).groupBy("shard").agg(F.min("_rank").alias("_first"))
    return plan


def _ranked(rows: DataFrame, plan: ShardPlan) -> DataFrame:
    """Each row's place on the line of all bytes, its global rank and its shard."""
    n, total = plan.n_shards, max(plan.total, 1)
    inside = Window.partitionBy("_range").orderBy("_k1", "_k2")
    group = Window.partitionBy("_range", "_k1")
    rows = rows.withColumn("_range", _range_of(plan.bounds)).withColumns(
        {
            "_upto": F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_at": F.row_number().over(inside),
        }
    )
    rows = rows.withColumns({"_end": F.max("_upto").over(group), "_bytes": F.sum("_size").over(group)})
    before = F.broadcast(plan.ranges.select("_range", "before_bytes", "before_rows"))  # at most MAX_RANGES rows
    rows = rows.join(before, "_range", "left")
    whole = F.col("_bytes") * n <= F.lit(WHOLE_GROUP * total)
    middle = F.col("before_bytes") + F.when(whole, F.col("_end") - F.col("_bytes") / 2).otherwise(
        F.col("_upto") - F.col("_size") / 2
    )
    shard = F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor(middle * n / total))).cast("int")
    return rows.withColumns({"_rank": F.col("before_rows") + F.col("_at"), "shard": shard}).drop(
        "_range", "_upto", "_at", "_end", "_bytes", "before_bytes", "before_rows"
    )


def assign(rows: DataFrame, plan: ShardPlan) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 in each shard); all other columns pass through."""
    firsts = F.broadcast(plan.firsts)  # one row a shard
    placed = _ranked(rows, plan).join(firsts, "shard", "left")
    return placed.withColumn("slot", (F.col("_rank") - F.col("_first")).cast("long")).drop("_rank", "_first", "_k1", "_k2")


def shard_documents(docs: DataFrame, n_shards: int) -> DataFrame:
    """Add ``shard`` and ``slot`` to documents (doc_id, text and more), with near equal bytes a shard.

    Columns of these names are replaced, all others stay.

    The plan is made from keys and sizes alone; then the documents are dealt once, by range.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "text")
    rows = keyed(rows, F.octet_length(text) + OVERHEAD, text, ["doc_id", "text"]).drop("doc_id", "text")
    slim = materialize(rows.select("_size", "_k1", "_k2"), "shard-keys")
    kept = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return assign(rows, shard_plan(slim, n_shards)).select(*kept, "shard", "slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """Write assigned records as one folder a shard, in slot order; a shard may take many tasks."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
