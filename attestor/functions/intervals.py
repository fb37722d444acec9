"""Truth intervals and their bounded (Lukasiewicz) logic, as struct<lower, upper> columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def interval(lower: Column | float, upper: Column | float) -> Column:
    as_column = lambda x: (x if isinstance(x, Column) else F.lit(float(x))).cast("double")
    return F.struct(as_column(lower).alias("lower"), as_column(upper).alias("upper"))


def known(value: Column | float) -> Column:
    return interval(value, value)


def of_bool(ok: Column) -> Column:
    """[1, 1] for true, [0, 0] for false, and all of [0, 1] for null."""
    return interval(F.when(ok, 1.0).otherwise(0.0), F.when(~ok, 0.0).otherwise(1.0))


def negate(a: Column) -> Column:
    return interval(1 - a["upper"], 1 - a["lower"])


def conjunction(xs: Sequence[Column]) -> Column:
    """All of some; true of none."""
    if not xs:
        return known(1.0)
    n = len(xs) - 1
    bound = lambda side: F.greatest(F.lit(0.0), sum((x[side] for x in xs[1:]), xs[0][side]) - n)
    return interval(bound("lower"), bound("upper"))


def disjunction(xs: Sequence[Column]) -> Column:
    """Any of some; false of none."""
    if not xs:
        return known(0.0)
    bound = lambda side: F.least(F.lit(1.0), sum((x[side] for x in xs[1:]), xs[0][side]))
    return interval(bound("lower"), bound("upper"))


def implication(a: Column, b: Column) -> Column:
    low, high = 1 - a["upper"] + b["lower"], 1 - a["lower"] + b["upper"]
    return interval(F.least(F.lit(1.0), low), F.least(F.lit(1.0), high))


def asserted(a: Column, lower: float = 1.0) -> Column:
    """With the lower bound raised, as by asserting it."""
    return interval(F.greatest(a["lower"], F.lit(lower)), a["upper"])


def contradicts(a: Column) -> Column:
    """Whether the bounds exclude each other."""
    return a["lower"] > a["upper"] + 1e-9
