"""Matches between two readings of the same source, exact, banded or fuzzy; always within an equi-key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.functions.exprs import all_same, alnum
from attestor.operators import contain
from attestor.operators.verify import last_by


def band(value: Column, floor: float = 0.1, share: float = 0.01) -> Column:
    """How far a number may lie from another and still agree with it."""
    return F.greatest(F.lit(floor), F.lit(share) * F.abs(value))


def compare_rates(text: DataFrame, figures: DataFrame, keys: Sequence[str], floor: float = 0.1) -> DataFrame:
    """Figure rows (keys, rate) with the last text row's rate of the same key: ``text_rate`` and ``agrees``."""
    told = last_by(text.select(*keys, F.col("rate").alias("text_rate"), "record_seq"), keys, "record_seq")
    told = told.select(F.xxhash64(*keys).alias("_hash"), *[F.col(k).alias(f"_k_{k}") for k in keys], "text_rate")
    cond = (F.xxhash64(*keys) == F.col("_hash")) & all_same([F.col(k) for k in keys], [F.col(f"_k_{k}") for k in keys])
    out = figures.join(told, cond, "left").drop("_hash", *[f"_k_{k}" for k in keys])
    near = F.abs(F.col("text_rate") - F.col("rate")) <= band(F.col("text_rate"), floor)
    return out.withColumn("agrees", F.when(F.col("text_rate").isNotNull(), F.coalesce(near, F.lit(False))))


def compare_summary(compared: DataFrame) -> DataFrame:
    """One row: total, matched, agree, disagree, net new."""
    m = F.col("text_rate").isNotNull()
    c = F.count_if
    return compared.agg(
        F.count(F.lit(1)).alias("total"), c(m).alias("matched"), c(F.col("agrees")).alias("agree"), c(m & ~F.col("agrees")).alias("disagree"), c(~m).alias("net_new")
    )


def _bucket(value: Column, floor: float, share: float = 0.01) -> Column:
    """Number of a bucket nine tenths of a band wide: of even width where the floor rules, of even ratio beyond."""
    size, edge = F.abs(value), floor / share
    bands = F.when(size <= edge, size / floor).otherwise((1 + F.ln(size / edge)) / share)
    return F.floor(F.signum(value) * bands / 0.9)


def close_rate_exists(rows: DataFrame, text: DataFrame, keys: Sequence[str], floor: float = 0.15) -> DataFrame:
    """Add ``close``: whether any text rate of the same key lies within the band; infinite rates and NaN never do.

    A band reaches no further than the second next bucket, and both of its ends grow with the rate it is
    drawn around.  So the greatest rate of the buckets below and the least of those above decide, and each
    row meets one row of two numbers, however many rates a key has.
    """
    finite = F.abs("rate") < float("inf")
    own = text.where(finite).groupBy(*keys, _bucket(F.col("rate"), floor).alias("_at")).agg(F.min("rate").alias("_low"), F.max("rate").alias("_high"))
    spread = own.withColumn("_by", F.explode(F.array(*[F.lit(i) for i in range(-2, 3)])))
    met = spread.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], (F.col("_at") + F.col("_by")).alias("_to")).agg(
        F.max(F.when(F.col("_by") > 0, F.col("_high"))).alias("_below"), F.min(F.when(F.col("_by") < 0, F.col("_low"))).alias("_above"),
        F.bool_or(F.col("_by") == 0).alias("_same"),
    )
    cond = F.when(finite, _bucket(F.col("rate"), floor)) == F.col("_to")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    near = lambda t: F.coalesce(F.abs(F.col("rate") - t) <= band(t, floor), F.lit(False))
    close = F.coalesce("_same", F.lit(False)) | near(F.col("_below")) | near(F.col("_above"))
    return rows.join(met, cond, "left").withColumn("close", close).drop("_to", "_below", "_above", "_same", *[f"_k_{k}" for k in keys])


def _unpacked(keys: Sequence[str]) -> list[Column]:
    return [F.col("_key")[f"k{i}"].alias(k) for i, k in enumerate(keys)]


def fuzzy_found(reference: DataFrame, found: DataFrame, keys: Sequence[str], name: str, prefix: int = 10, width: int = 40) -> DataFrame:
    """Distinct reference names by key with ``found``: one name holds the other, or their beginnings are equal.

    A null name is never found; an empty one is where the key has any name, and finds all names of its key.
    """
    norm = F.substring(alnum(F.col(name)), 1, width).alias("name")
    mine, other = (df.select(contain.key(keys).alias("_key"), norm).distinct() for df in (reference, found))
    begins = other.select("_key", F.substring("name", 1, prefix).alias("_begin")).distinct()
    some, empty = other.where("name is not null").select("_key").distinct(), other.where("name = ''").select("_key")
    hits = (
        contain.holding(mine, other).select("_key", F.col("needle").alias("name")),
        contain.holding(other, mine).select("_key", F.col("hay").alias("name")),
        mine.withColumn("_begin", F.substring("name", 1, prefix)).join(begins, ["_key", "_begin"]).select("_key", "name"),
        mine.where("name = ''").join(some, "_key", "left_semi"),
        mine.where("name is not null").join(empty, "_key", "left_semi"),
    )
    hit = reduce(DataFrame.unionByName, hits).distinct().withColumn("_hit", F.lit(True))
    out = mine.join(hit, ["_key", "name"], "left")
    return out.select(*_unpacked(keys), "name", F.coalesce("_hit", F.lit(False)).alias("found"))


def overlapping(candidates: DataFrame, rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Candidates of each row on its page whose names overlap (one holds the other, or they share a run of six
    characters); where none does, all of the page.  Adds ``cand_name`` and ``overlap``.

    Pairs come from the runs of distinct names; only rows without any meet their whole page.  A null name
    overlaps nothing.
    """
    cands = candidates.select(contain.key(keys).alias("_key"), F.col(name).alias("cand_name")).distinct().withColumn("_b", alnum(F.col("cand_name")))
    own = rows.withColumns({"_key": contain.key(keys), "_a": alnum(F.col(name))})
    pairs = contain.overlapping_names(own.select("_key", F.col("_a").alias("name")).distinct(), cands.select("_key", F.col("_b").alias("name")).distinct())
    pairs = pairs.select("_key", F.col("a").alias("_a"), F.col("b").alias("_b"))
    met = own.join(pairs, ["_key", "_a"]).join(cands, ["_key", "_b"]).withColumn("overlap", F.lit(True))
    alone = own.join(pairs, ["_key", "_a"], "left_anti").join(cands.drop("_b"), "_key").withColumn("overlap", F.lit(False))
    return met.drop("_b").unionByName(alone).drop("_key", "_a")


def first_match(rows: DataFrame, other: DataFrame, keys: Sequence[str], name: str, prefix: int = 8) -> DataFrame:
    """Each row with the value of the first other row of its key whose name begins alike."""
    short = F.substring(alnum(F.col(name)), 1, prefix)
    first = other.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], short.alias("_short")).agg(F.min_by("value", "record_seq").alias("matched_value"))
    cond = short == F.col("_short")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(first, cond, "left").drop("_short", *[f"_k_{k}" for k in keys])


def best_match(rows: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Each row with ``match_rate``: of the other rows of its key whose name holds its name or is held by it,
    the first that has a rate, else null.  ``matched`` tells whether any name fits; a null name fits none."""
    first = F.min(F.struct(F.col("rate").isNull().alias("no"), F.col("record_seq").alias("seq"), F.col("rate").alias("rate"))).alias("_first")
    got = other.select(contain.key(keys).alias("_key"), alnum(F.col(name)).alias("name"), "rate", "record_seq").where("name is not null").groupBy("_key", "name").agg(first)
    own = rows.withColumns({"_key": contain.key(keys), "_mine": alnum(F.col(name))})
    mine, names = own.where("_mine is not null").select("_key", F.col("_mine").alias("name")).distinct(), got.select("_key", "name")
    pairs = contain.holding(mine, names).select("_key", F.col("needle").alias("_mine"), F.col("hay").alias("name"))
    pairs = pairs.unionByName(contain.holding(names, mine).select("_key", F.col("hay").alias("_mine"), F.col("needle").alias("name")))
    any_ = got.groupBy("_key").agg(F.min("_first").alias("_first"))
    as_mine = F.col("name").alias("_mine")
    fits = (
        pairs.join(got, ["_key", "name"]).select("_key", "_mine", "_first"),
        mine.where("name = ''").join(any_, "_key").select("_key", as_mine, "_first"),
        mine.join(got.where("name = ''").drop("name"), "_key").select("_key", as_mine, "_first"),
    )
    best = reduce(DataFrame.unionByName, fits).groupBy("_key", "_mine").agg(F.min("_first").alias("_best"))
    out = own.join(best, ["_key", "_mine"], "left").select(*rows.columns, "_best")
    return out.withColumns({"matched": F.col("_best").isNotNull(), "match_rate": F.col("_best.rate")}).drop("_best")


def lift_summary(scored: DataFrame, floor: float = 0.2) -> DataFrame:
    """One row: by a true rate, how many rows a new reading fixes, a baseline had right, and people must judge."""
    near = lambda c: F.coalesce(F.abs(F.col(c) - F.col("truth")) <= band(F.col("truth"), floor), F.lit(False))
    known = F.col("truth").isNotNull()
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(known & near("rate") & ~near("baseline")).alias("fixed"), F.count_if(known & near("baseline")).alias("baseline_right"),
        F.count_if(known & ~near("rate") & near("baseline")).alias("broken"), F.count_if(~known).alias("needs_human"),
    )


def counts_by_source(labels: DataFrame, source: str = "label_source") -> DataFrame:
    """(source, n, n_rated): where number labels came from, and how many were given a series."""
    return labels.groupBy(source).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("series").isNotNull()).alias("n_attributed"))


def number_labels(words: DataFrame) -> DataFrame:
    """Words that are number labels of a figure: up to three digits, a fraction, a percent sign."""
    return words.where(F.col("word").rlike(r"^\d{1,3}(\.\d+)?%?$")).withColumn("value", F.replace("word", F.lit("%"), F.lit("")).cast("double"))
