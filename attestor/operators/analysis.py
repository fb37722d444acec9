"""Aggregates over released records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestor.functions.exprs import blank_to_null, to_double


def coverage(records: DataFrame) -> DataFrame:
    """One row: records, distinct states, plans by state, and measures; all exact, a null counting as a value.

    Records are counted by all three once; what is distinct is counted among these few rows.
    """
    seen = records.groupBy("state", "plan_name", "measure_name").agg(F.count(F.lit(1)).alias("n"))
    distinct = lambda *cols: F.count_distinct(F.struct(*cols))
    return seen.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"), distinct("state").alias("n_states"), distinct("state", "plan_name").alias("n_state_plans"), distinct("measure_name").alias("n_measures")
    )


def top_names(records: DataFrame, name: str, n: int = 12) -> DataFrame:
    """The n most frequent names; ties in the order of first appearance."""
    return records.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.min("record_seq").alias("first_seq")).orderBy(F.desc("n"), "first_seq").limit(n)


def mean_rate_by_state(records: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """(keyword, state, n, mean_rate) of percent rates that aren't failed, for names that hold the keyword."""
    usable = records.where((F.col("rate_unit") == "percent") & (F.col("qa_status") != "fail"))
    if dict(records.dtypes)["rate"] in ("double", "bigint", "int", "smallint", "tinyint"):  # numbers that text would only repeat
        rate = F.col("rate").cast("double")
        usable = usable.where((F.abs(rate) < float("inf")) & ~F.isnan(rate)).withColumn("_rate", rate)
    else:
        usable = usable.withColumn("_rate", to_double(F.col("rate").cast("string"))).where("_rate is not null")
    # names are looked into once, not once a record
    named = usable.groupBy("state", "measure_name").agg(F.count(F.lit(1)).alias("n"), F.sum("_rate").alias("_sum"))
    hits = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(F.lower("measure_name"), F.lower(k)))
    rows = named.select("state", "n", "_sum", F.explode(hits).alias("keyword")).groupBy("keyword", "state")
    return rows.agg(F.sum("n").alias("n"), (F.sum("_sum") / F.sum("n")).alias("mean_rate"))


def determination_mix(records: DataFrame) -> DataFrame:
    """(determination, n) of compliance findings; none is counted as null."""
    findings = records.where("record_type = 'eqr_compliance'")
    return findings.groupBy(blank_to_null(F.col("determination")).alias("determination")).agg(F.count(F.lit(1)).alias("n"))


def qa_mix(records: DataFrame) -> DataFrame:
    return records.groupBy("qa_status").agg(F.count(F.lit(1)).alias("n"), F.count_if("review_recommended").alias("n_review"))


def state_by_type(records: DataFrame, kinds: Sequence[str], kind: str = "record_type") -> DataFrame:
    """Counts by state with one column a kind, and their total; the state of the greatest total first, equal ones by name."""
    counts = [F.count_if(F.col(kind) == k).alias(k) for k in kinds]
    return records.groupBy("state").agg(*counts).withColumn("total", sum((F.col(k) for k in kinds[1:]), F.col(kinds[0]))).orderBy(F.desc("total"), "state")


def check_claims(records: DataFrame, claims: DataFrame, by: str, value: str) -> DataFrame:
    """(by, claimed, actual, holds): stated counts against counted ones, missing on either side included."""
    actual = records.groupBy(by).agg(F.count(F.lit(1)).alias("actual"))
    said = claims.select(F.col(by).alias("_by"), F.col(value).alias("claimed"))
    out = actual.join(said, F.col(by).eqNullSafe(F.col("_by")), "full")
    return out.select(F.coalesce(by, "_by").alias(by), "claimed", "actual", F.coalesce(F.col("claimed") == F.col("actual"), F.lit(False)).alias("holds"))
