"""Continuous ingestion: a stream of documents, each content once, extracted, verified and merged by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from attestor.operators.release_table import BUCKETS, ReleaseTable
from attestor.plans.datasets import Dataset
from attestor.plans.pipeline import run

DOCUMENTS = (
    "ordinal long, document_id string, source_url string, jurisdiction string, program string, publisher string, report_year int, "
    "text string, arrived timestamp"
)


def document_stream(spark: SparkSession, path: str, late: str = "1 day", files_per_batch: int = 100) -> DataFrame:
    """JSON documents as they land in a folder; a content seen within ``late`` before is dropped."""
    raw = spark.readStream.schema(DOCUMENTS).option("maxFilesPerTrigger", files_per_batch).json(path)
    ids = raw.withColumn("document_id", F.coalesce("document_id", F.sha2("text", 256)))
    return ids.withWatermark("arrived", late).dropDuplicatesWithinWatermark(["document_id"])


def ingest(docs: DataFrame, ds: Dataset, out: str, checkpoint: str, once: bool = False, n_buckets: int = BUCKETS) -> StreamingQuery:
    """Extract and verify every micro-batch and merge it into the release table at ``out``.

    A batch rewrites the buckets of its own documents only.  The table remembers the last batch of this checkpoint,
    so a batch that is run again after a failure changes nothing, and numbers may be skipped.
    """

    def wave(batch: DataFrame, number: int) -> None:
        table = ReleaseTable(batch.sparkSession, out, n_buckets=n_buckets)
        if table.version().batches.get(checkpoint, -1) >= number:
            return
        result = run(batch.drop("arrived"), ds)
        records = table.staged(result.records.drop("signals").withColumn("document_id", F.col("provenance.source_document_id")))
        table.merge(records, result.documents.select("document_id"), checkpoint, number)
        table.clear()

    writer = docs.writeStream.foreachBatch(wave).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_counts(events: DataFrame, at: str = "ts", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by event-time window and type; late events are counted while the watermark allows."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select("w.start", "event_type", "n")
