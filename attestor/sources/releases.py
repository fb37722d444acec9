"""Published releases, predictions and reviewer sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.functions.exprs import row_uid
from attestor.operators.curate import record_ddl
from attestor.operators.evaluate import labels
from attestor.plans.datasets import Dataset


class InvalidRelease(ValueError):
    """A release that can't be merged with."""


def load_release(spark: SparkSession, path: str, ds: Dataset) -> tuple[DataFrame, DataFrame]:
    """(records, documents) of a release folder; fails fast where it is unreadable, foreign or empty."""
    try:
        records = spark.read.schema(record_ddl(ds)).json(f"{path}/records.jsonl")
        documents = spark.read.option("header", True).option("nullValue", "").csv(f"{path}/documents.csv")
    except Exception as e:
        raise InvalidRelease(f"{path}: {e}") from e
    seen = records.select("record_type").distinct().limit(100).collect()
    foreign = sorted(str(r[0]) for r in seen if r[0] not in ds.kinds)
    if foreign:
        raise InvalidRelease(f"{path}: unknown record types {', '.join(foreign)}")
    if not seen:
        raise InvalidRelease(f"{path}: no records")
    return records, documents


def load_predictions(spark: SparkSession, folder: str, ds: Dataset) -> DataFrame:
    """The dataset's first table as texts, with ``row_uid`` and ``record_seq``."""
    from attestor.plans.datasets import KINDS

    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{folder}/{KINDS[ds.kinds[0]].table}.csv")
    return rows.withColumns({"row_uid": row_uid(ds.identity), "record_seq": F.monotonically_increasing_id()})


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    """(row_uid, correct) of a reviewer's sheet; of equal uids the last counts."""
    rows = spark.read.option("header", True).csv(path).withColumn("record_seq", F.monotonically_increasing_id())
    return labels(rows)
