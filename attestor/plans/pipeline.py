"""Whole runs: extract, verify, curate; and incremental waves that merge with the last release."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.functions.exprs import blank_to_null
from attestor.operators import curate, extract
from attestor.operators.merge import replace_by_id
from attestor.operators.text import first_by_content
from attestor.operators.verify import omissions, summarize, verify
from attestor.plans.datasets import Dataset

DOCUMENT_COLUMNS = (*extract.DOCUMENT, "title", "n_pages", "text_sha256")


@dataclass
class Run:
    """Scored records, quarantined rows, the documents and the one-row report."""

    records: DataFrame
    rejected: DataFrame
    documents: DataFrame
    report: DataFrame


def compared(ds: Dataset) -> Column:
    """Which records a second extraction is compared on."""
    return F.col("record_type") == ds.ensemble_kind


def with_keys(records: DataFrame, ds: Dataset) -> DataFrame:
    """Records with the derived columns that identities need."""
    if "ccn_or_facility" in ds.ensemble_key:
        return records.withColumn("ccn_or_facility", F.coalesce(blank_to_null(F.col("ccn")), F.col("facility_name")))
    return records


def score(records: DataFrame, ds: Dataset, docs: DataFrame | None = None, second: DataFrame | None = None) -> DataFrame:
    """All verifiers of a dataset on its records."""
    texts = None if docs is None else first_by_content(docs, "ordinal").select("document_id", "text")
    other = None if second is None else with_keys(second, ds)
    return verify(with_keys(records, ds), ds.axioms(), texts, other, ds.ensemble_key, ds.ensemble_fields, compared(ds)).drop("ccn_or_facility")


def documents_table(docs: DataFrame) -> DataFrame:
    """One row a document: its columns, pages and the hash by which a drift of its text shows."""
    from attestor.operators.text import page_count

    return docs.select(*extract.DOCUMENT, *[c for c in ("title",) if c in docs.columns], page_count(F.col("text")).alias("n_pages"), F.sha2("text", 256).alias("text_sha256"))


def run(docs: DataFrame, ds: Dataset, payloads: DataFrame | None = None, second: DataFrame | None = None, extractor: str | None = None) -> Run:
    """Extract and verify ``docs`` (ordinal, text and the document columns).

    ``extractor`` names what makes the records: by default ``llm`` where ``payloads`` are given, else ``rule``.  All but
    ``rule`` need payloads.  ``second`` is another extraction of the same documents to compare with.
    """
    name = extractor or ("rule" if payloads is None else "llm")
    make = extract.extractor(name)
    if name != "rule" and payloads is None:
        raise ValueError(f"extractor {name!r} needs the answers of its model")
    found = make(docs if name == "rule" else payloads, ds)
    good, bad = extract.quarantine(found, ds)
    scored = score(good, ds, docs, second)
    report = summarize(scored)
    if second is not None:
        gone = omissions(with_keys(good, ds), with_keys(second, ds), ds.ensemble_key, compared(ds)).agg(F.count(F.lit(1)).alias("_lost"))
        report = report.drop("ensemble_omissions").crossJoin(gone).withColumnRenamed("_lost", "ensemble_omissions")  # one row each
    return Run(scored, bad, documents_table(docs), report)


def merge_wave(old_records: DataFrame, old_documents: DataFrame, wave: Run) -> Run:
    """The last release with the wave's documents replaced; old records keep their stored trust."""
    records = replace_by_id(
        old_records.withColumn("document_id", F.col("provenance.source_document_id")),
        wave.records.drop("signals").withColumn("document_id", F.col("provenance.source_document_id")), wave.documents,
    ).drop("document_id")
    documents = replace_by_id(old_documents, wave.documents, wave.documents)
    return Run(records, wave.rejected, documents, summarize(records))


def publish(result: Run, ds: Dataset, out: str, parquet: bool = True) -> dict:
    """Write tables, records, documents and the descriptions; returns counts and the summary."""
    records = result.records.persist()  # several outputs of one lineage
    try:
        counts = curate.curate(records, result.documents, out, ds, parquet)
        summary = result.report.first().asDict()
    finally:
        records.unpersist()
    spark = records.sparkSession
    texts = {
        "DATA_DICTIONARY.md": curate.data_dictionary(ds), "README.md": curate.dataset_card(ds, counts["tables"], summary),
        "croissant.json": curate.croissant(ds, counts["tables"], out, "CC-BY-4.0"),
    }
    spark.createDataFrame(list(texts.items()), "name string, value string").repartition(1).write.mode("overwrite").partitionBy("name").text(f"{out}/meta")
    return {**counts, "summary": summary}
