"""Joins of names that hold one another or share a run of characters, within a key, without comparing all of a key.

Both sides are distinct ``(_key, name)`` tables: ``_key`` a struct of the key columns, so that nulls equal
each other, and ``name`` a normalised string.  Null names meet nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of an indexed run; shorter names are found as runs of their own length.
GRAM = 6


def key(keys: Sequence[str]) -> Column:
    """The key columns as one column in which nulls equal each other; without key columns all rows have one key."""
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.struct(F.lit(0).alias("k0"))


def runs(name: Column, n: Column | int) -> Column:
    """Distinct runs of n characters of a name of at least n; none of a shorter one."""
    n = n if isinstance(n, Column) else F.lit(n)
    last = F.length(name) - n + 1
    return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(name, i, n)))).otherwise(F.array().cast("array<string>"))


def holding(needles: DataFrame, hays: DataFrame, gram: int = GRAM) -> DataFrame:
    """(_key, needle, hay): pairs of a key of which the second name holds the first; the empty needle is left out.

    Hays are indexed by their runs of ``gram`` characters, and by runs of the lengths that shorter needles of
    their key have.  A needle meets the hays that have its rarest run, and none where it has a run that no hay
    has; what meets is verified.  So a needle costs what its rarest run does, whatever else its key holds.
    """
    needles = needles.where("name <> ''").select("_key", F.col("name").alias("needle"), F.least(F.length("name"), F.lit(gram)).alias("_m"))
    lengths = needles.groupBy("_key").agg(F.collect_set("_m").alias("_ms"))  # at most ``gram`` numbers a key
    index = hays.join(lengths, "_key").select("_key", F.col("name").alias("hay"), F.explode(F.flatten(F.transform("_ms", lambda m: runs(F.col("name"), m)))).alias("_run"))
    common = index.groupBy("_key", "_run").agg(F.count(F.lit(1)).alias("_n"))
    asked = needles.withColumn("_run", F.explode(runs(F.col("needle"), F.col("_m")))).join(common, ["_key", "_run"], "left")
    rarest = asked.groupBy("_key", "needle").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_run").alias("run"))).alias("_r"))
    probes = rarest.where("_r.n > 0").select("_key", "needle", F.col("_r.run").alias("_run"))
    return probes.join(index, ["_key", "_run"]).where(F.contains("hay", F.col("needle"))).select("_key", "needle", "hay")


def sharing(left: DataFrame, right: DataFrame, gram: int = GRAM) -> DataFrame:
    """(_key, a, b): pairs of a key that share a run of ``gram`` characters, each once.

    Runs are made once a name.  A pair is taken at the least run of all that it shares, so none has to be
    made distinct afterwards.
    """
    a = left.select("_key", F.col("name").alias("a"), runs(F.col("name"), gram).alias("_ra")).withColumn("_run", F.explode("_ra"))
    b = right.select("_key", F.col("name").alias("b"), runs(F.col("name"), gram).alias("_rb")).withColumn("_run", F.explode("_rb"))
    met = a.join(b, ["_key", "_run"])
    return met.where(F.array_min(F.array_intersect("_ra", "_rb")) == F.col("_run")).select("_key", "a", "b")


def overlapping_names(left: DataFrame, right: DataFrame, gram: int = GRAM) -> DataFrame:
    """(_key, a, b): pairs of a key of which one holds the other or that share a run of ``gram`` characters.

    Names that short ones hold or are held by are found by their own lengths; a pair may come twice then, so
    these few are made distinct.
    """
    short = lambda df: df.where((F.length("name") < gram) & (F.col("name") != ""))
    held = holding(short(left), right, gram).select("_key", F.col("needle").alias("a"), F.col("hay").alias("b"))
    holds = holding(short(right), left, gram).select("_key", F.col("hay").alias("a"), F.col("needle").alias("b"))
    # every name holds the empty one: this is what is asked for, and as many pairs as there are such names
    nothing = lambda df: df.where("name = ''")
    empty_a = nothing(left).select("_key", F.col("name").alias("a")).join(right.where("name is not null").select("_key", F.col("name").alias("b")), "_key")
    empty_b = nothing(right).select("_key", F.col("name").alias("b")).join(left.where("name is not null").select("_key", F.col("name").alias("a")), "_key")
    rest = held.unionByName(holds).unionByName(empty_a).unionByName(empty_b).distinct()
    return sharing(left, right, gram).unionByName(rest)
