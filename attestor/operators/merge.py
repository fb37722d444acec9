"""Incremental merges of releases: what new documents replace, and what stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestor.functions.states import state_name


def replace_by_id(existing: DataFrame, new: DataFrame, new_docs: DataFrame, key: str = "document_id", on: str | None = None) -> DataFrame:
    """``existing`` without rows of documents among ``new_docs``, and all of ``new``.

    A document that was extracted again without any record thus loses its old records.  ``on`` names
    the document id in the records where it differs from ``key``.
    """
    ids = new_docs.select(F.col(key).alias("_id")).distinct()
    return existing.join(ids, existing[on or key] == F.col("_id"), "left_anti").unionByName(new, allowMissingColumns=True)


def latest_release(names: DataFrame) -> DataFrame:
    """The newest of (name, modified): by semantic version, then by time; names without one rank lowest."""
    part = lambda i: F.coalesce(F.regexp_extract("name", r"[-_]v(\d+)\.(\d+)\.(\d+)", i).try_cast("int"), F.lit(-1))
    return names.agg(F.max_by("name", F.struct(part(1), part(2), part(3), "modified")).alias("name"))


def new_sources(candidates: DataFrame, known: DataFrame, order: str) -> DataFrame:
    """Verified candidates whose URL is neither published nor seen before; the first of equal URLs."""
    fresh = candidates.where(F.col("verified")).join(known.select("url").distinct(), "url", "left_anti")
    w = Window.partitionBy("url").orderBy(order)
    year = F.coalesce(F.col("year").try_cast("int"), F.lit(2024))
    return fresh.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth").withColumn("year", year)


def names_by_state(rows: DataFrame, state: str, name: str, width: int = 80) -> DataFrame:
    """(state, names): the sorted distinct names of each state, cut to ``width``, comma-joined."""
    return rows.groupBy(state).agg(F.array_join(F.array_sort(F.collect_set(F.substring(name, 1, width))), ", ").alias("names"))


def exclusions(rows: DataFrame, state: str, name: str, width: int = 80) -> DataFrame:
    """(state, names): for each state, by its full name, the sorted distinct names that are published already.

    Rows whose state is no postal code, or that have no name, are left out.  Names are made distinct before they meet
    in their state's row, which is as long as the state has names.
    """
    named = rows.select(state_name(F.col(state)).alias("state"), F.substring(name, 1, width).alias("name")).where("state is not null and name <> ''").distinct()
    return named.groupBy("state").agg(F.array_sort(F.collect_list("name")).alias("names"))
