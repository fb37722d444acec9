"""Selective acceptance: the lowest trust threshold whose accepted set's error is bounded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.functions.exprs import hoeffding
from attestor.operators.ranges import running


def thresholds(labelled: DataFrame, alpha: float, delta: float, by: str | None = None) -> DataFrame:
    """(by, threshold) from (score, correct, by): the least score at which the bound holds, null for none.

    Counts by distinct score come first, so all ties of a score enter together; running sums go over distinct
    scores, in ranges.  A lower score may qualify although a higher one doesn't.
    """
    keys = [by] if by else []
    scores = labelled.groupBy(*keys, "score").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("correct")).alias("e"))
    run = running(scores, [-F.col("score")], {"n": F.col("n"), "e": F.col("e")}, keys)
    best = F.min(F.when(hoeffding(F.col("e"), F.col("n"), delta) <= alpha, F.col("score"))).alias("threshold")
    return run.groupBy(*keys).agg(best)


def annotate(records: DataFrame, overall: DataFrame, groups: DataFrame | None = None, by: str | None = None) -> DataFrame:
    """Add ``threshold`` and ``review_recommended``.

    A group that was calibrated keeps its threshold, even where none qualified; others take the
    overall one.  A null score goes to review; the QA status plays no part here.
    """
    out = records.crossJoin(F.broadcast(overall.select(F.col("threshold").alias("_all"))))  # one row
    own: Column = F.col("_all")
    if groups is not None:
        g = groups.select(F.col(by).alias("_g"), F.col("threshold").alias("_own"), F.lit(True).alias("_seen"))
        out = out.join(F.broadcast(g), F.col(by).eqNullSafe(F.col("_g")), "left")  # one row a group
        own = F.when(F.col("_seen"), F.col("_own")).otherwise(F.col("_all"))
    accept = F.coalesce(F.col("trust_score") >= own, F.lit(False))
    out = out.withColumns({"threshold": own, "review_recommended": ~accept})
    return out.drop("_all", "_g", "_own", "_seen")


def summary(annotated: DataFrame) -> DataFrame:
    """One row: n, auto_accepted, sent_to_review, coverage."""
    n, kept = F.count(F.lit(1)), F.count_if(~F.col("review_recommended"))
    return annotated.agg(
        n.alias("n"), kept.alias("auto_accepted"), (n - kept).alias("sent_to_review"),
        F.when(n > 0, F.round(kept / n, 4)).otherwise(0.0).alias("coverage"),
    )


def calibrated_summary(annotated: DataFrame, alpha: float, delta: float, stratified: bool) -> DataFrame:
    """``summary`` with what the gate was calibrated by, and whether groups have thresholds of their own."""
    return summary(annotated).select(F.lit(alpha).alias("alpha"), F.lit(delta).alias("delta"), "*", F.lit(stratified).alias("stratified"))
