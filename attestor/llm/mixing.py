"""Mixing sources to target weights by a time-varying curriculum (DataFrame functions only).

Each source has a weight schedule over training time t in [0, 1], w(t) = weight * (1 + tilt * (2t - 1)).
Its integral, the weight, sets the source's share of all words; its running integral is the source's
cumulative demand.  A source's words lie on a line in a hashed order that repeats once a pass; a word
at fraction q of the demand is trained at the time t where the running integral reaches q.  Documents
are finally range-sorted by that position.

Nulls: a null text has no words and is never taken; a null source is a source of its own, last in
order.  Repeated rows are separate documents.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestor.llm.ranges import MAX_RANGES, offsets
from attestor.llm.scratch import materialize

#: Rows that one (source, bin) window holds at most on average.
BIN_ROWS = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, repeats: float) -> DataFrame:
    """Words to take from each source.

    ``sizes`` has one row a source (source, source_size).  Sources in code-point order, null last, take
    ``weights`` in turn.  The water level is found in one pass: by ascending cap-to-weight ratio, a
    source is capped while the level that the rest would reach still exceeds its cap.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())  # one row a source
    ratio = Window.partitionBy(F.lit(0)).orderBy("_ratio", F.col("source").asc_nulls_last())
    before, every = ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("_w", F.get(kinds, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))))
    s = s.withColumns({"_cap": F.col("source_size") * repeats, "_ratio": F.col("source_size") * repeats / F.col("_w")})
    s = s.withColumns(
        {
            "_left": F.sum("source_size").over(every) * share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
            "_rest": F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)),
        }
    ).withColumn("_level", F.col("_left") / F.col("_rest"))
    open_ = F.col("_level") * F.col("_w") <= F.col("_cap")
    level = F.coalesce(F.max(F.when(open_, F.struct(-F.col("_ratio"), F.col("_level").alias("x")))).over(every)["x"], F.lit(float("inf")))
    return s.select("source", "source_size", F.least(F.col("_cap"), level * F.col("_w")).alias("target"))


def _time(q: Column, tilt: float) -> Column:
    """Where the running integral of 1 + tilt * (2t - 1) reaches q."""
    if not tilt:
        return q
    a = float(tilt)
    return F.abs(F.sqrt(F.lit((1 - a) ** 2) + 4 * a * q) - (1 - a)) / abs(2 * a)


def _hash() -> Column:
    return F.xxhash64(F.lit(11), "doc_id", "text")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    tilts: Sequence[float] = (0.5, 0.0, -0.5),
    share: float = 1.5,
    repeats: float = 2.0,
) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, taken and its training positions.

    ``position`` (0 to all words of the mix) is where its first taken word is trained, ``again`` where
    its second pass begins; both null where not taken.  The pass that meets the end of the demand is
    cut at a word, so a source's words add up to its target, rounded.
    """
    return _placed(docs, weights, tilts, share, repeats).drop("_h")


def _placed(docs: DataFrame, weights: Sequence[float], tilts: Sequence[float], share: float, repeats: float) -> DataFrame:
    """The rows of ``mix`` with the hash ``_h`` of id and text."""
    slim = materialize(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            _hash().alias("_h"),
        ),
        "mix-sizes",
    )
    n_bins = min(MAX_RANGES, max(64, slim.count() // BIN_ROWS))
    slim = slim.withColumn("_bin", F.pmod(F.shiftright("_h", 32), F.lit(n_bins)).cast("int"))
    bins = offsets(slim, ["source"], ["_bin"], {"words": "size"}).select("source", "_bin", "all_words", "before_words")
    sizes = bins.groupBy("source").agg(F.sum("all_words").alias("source_size"))
    goal = targets(sizes, weights, share, repeats)
    goal = goal.withColumn("_tilt_at", F.pmod(F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(tilts))))
    goal = goal.withColumn("_all", F.sum("target").over(Window.partitionBy(F.lit(0))))
    plan = bins.select(F.col("source").alias("_s"), F.col("_bin").alias("_b"), "before_words")
    plan = materialize(plan.join(goal, F.col("_s").eqNullSafe(F.col("source"))).drop("source"), "mix-plan")
    inside = Window.partitionBy("source", "_bin").orderBy("_h", "doc_id")
    placed = slim.withColumn("_upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    placed = placed.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_b")))
    start = F.col("before_words") + F.col("_upto") - F.col("size")
    demand = F.round("target").cast("long")
    passes = [F.greatest(F.lit(0), F.least(F.col("size"), demand - k * F.col("source_size") - start)) for k in range(int(-(-repeats // 1)))]
    curves = [_time(F.least(F.lit(1.0), (start + k * F.col("source_size")) / F.col("target")), t) for k in (0, 1) for t in tilts]
    at = lambda k: F.get(F.array(*curves[k * len(tilts) : (k + 1) * len(tilts)]), F.col("_tilt_at")) * F.col("_all")
    return placed.select(
        "_h", "doc_id", "source", "size", "source_size", "target",
        sum(passes[1:], passes[0]).cast("long").alias("taken"),
        F.when(passes[0] > 0, at(0)).alias("position"),
        (F.when(passes[1] > 0, at(1)) if len(passes) > 1 else F.lit(None).cast("double")).alias("again"),
    )


def take(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), tilts: Sequence[float] = (0.5, 0.0, -0.5), share: float = 1.5, repeats: float = 2.0
) -> DataFrame:
    """The mix as documents, columns as they came: each as often as its words are taken, rounded.

    Words of a document are taken wholly but where a source's demand ends, so rounding moves a source
    by half a document at most.  Documents without words are not taken.  Rows are told apart by id (null ids
    too), text and source, so texts that share an id each keep their own count.  Rows equal in all three lie
    side by side in the mix: all are taken equally often, and what is left of their count, where a demand ends among
    them, goes to one of them.
    """
    n = F.round(F.col("taken") / F.col("size")).cast("long")
    placed = _placed(docs, weights, tilts, share, repeats).where("size > 0").withColumn("_n", n)
    copies = placed.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_s"), F.col("_h").alias("_hash")).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    copies = copies.where("_n > 0").withColumns({"_each": F.floor(F.col("_n") / F.col("_rows")).cast("int"), "_more": F.pmod("_n", "_rows").cast("int")})
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_key"), F.col("source").alias("_source"), _hash().alias("_h"))
    same = (F.col("_h") == F.col("_hash")) & F.col("_key").eqNullSafe(F.col("_id")) & F.col("_source").eqNullSafe(F.col("_s"))
    times = lambda df, c: df.select("_row", F.explode(F.sequence(F.lit(1), F.col(c)))).select("_row.*")
    taken = times(rows.join(copies.where("_each > 0"), same), "_each")
    few = copies.where("_more > 0")  # where a demand ends among equal rows: a row a source and pass at most
    rest = rows.join(F.broadcast(few), same).groupBy("_h", "_key", "_source").agg(F.any_value("_row").alias("_row"), F.max("_more").alias("_more"))
    return taken.unionByName(times(rest, "_more"))


def range_sorted(mixed: DataFrame) -> DataFrame:
    """Range-sort by training position; documents that are not taken come last."""
    return mixed.orderBy(F.col("position").asc_nulls_last(), "doc_id")
