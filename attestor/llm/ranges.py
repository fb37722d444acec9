"""Exact global ranks and prefix sums without a single-task window.

Rows are dealt into ranges of a sort key; a window runs inside each range, and the totals of the
ranges (a bounded table, one row a range) are summed in order and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most ranges that any call makes; bounds the totals table and the boundary literals.
MAX_RANGES = 8192
#: The least long.
LOWEST = -(1 << 63)


def range_count(df: DataFrame, least: int = 64) -> int:
    """Ranges for a session: several for each shuffle partition, so that hashing deals them evenly."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MAX_RANGES, 8 * parts))


def unit_interval(*cols: Column | str) -> Column:
    """A uniform number in [0, 1) that depends on the columns' values alone."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def long_literal(x: int) -> str:
    """SQL for a long, the least one included."""
    return f"{x}L" if x > LOWEST else f"({LOWEST + 1}L - 1L)"


def in_range(key: Column, bounds: Sequence[int | None]) -> Column:
    """Number of ``bounds`` (ascending) that are at most ``key``: two short scans, not one long one.

    A null key belongs to range 0.
    """
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [list(bounds[i : i + step]) for i in range(0, len(bounds), step)]
    heads = F.expr(f"array({', '.join(long_literal(b[0]) for b in blocks)})")
    table = F.expr(f"array({', '.join('array(' + ', '.join(map(long_literal, b)) + ')' for b in blocks)})")
    block = F.size(F.filter(heads, lambda x: x <= key))
    inside = F.size(F.filter(F.get(table, block - 1), lambda x: x <= key))
    return F.when(key.isNull() | (block <= 0), 0).otherwise((block - 1) * step + inside).cast("int")


def offsets(df: DataFrame, by: Sequence[str], order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Totals of each range and what all earlier ranges hold together.

    ``by`` names columns within which sums start anew, ``order`` the range columns.  ``sums`` maps an
    output name to the summed column ("" counts rows); each gets ``before_<name>``.  The window runs
    over one row a range.
    """
    aggs = [(F.sum(c) if c else F.count(F.lit(1))).cast("long").alias(f"all_{n}") for n, c in sums.items()]
    totals = df.groupBy(*by, *order).agg(*aggs)
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(*order)
    w = w.rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "*", *[F.coalesce(F.sum(f"all_{n}").over(w), F.lit(0)).cast("long").alias(f"before_{n}") for n in sums]
    )
