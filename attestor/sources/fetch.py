"""Candidates' bytes: fetched once, stored under their hash, failures as rows that are tried again.

A store has two tables by document and by url (``ReleaseTable``): ``objects`` (document_id, content, n_bytes, mime) holds each
content once, ``fetched`` (url, ok, document_id, error, tries) says what came of each url.  Objects are committed
before what names them, so a run that is cut off leaves at most objects that the next run finds stored.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.operators.release_table import ReleaseTable

Fetcher = Callable[[str], bytes]
FETCHED = "url string, ok boolean, document_id string, error string, tries int"
OBJECTS = "document_id string, content binary, n_bytes long, mime string"


def by_fetcher(urls: DataFrame, fetcher: Fetcher, tasks: int | None = None, retries: int = 3, wait: float = 1.0) -> DataFrame:
    """(url, content, error): the fetcher is called in tasks, waits double between tries, and what fails for good is a row."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for url in batch["url"]:  # a row at a time: contents may be large
                content, error = None, None
                for n in range(retries):
                    try:
                        content, error = fetcher(url), None
                        break
                    except Exception as e:  # whatever a fetcher raises is worth a retry
                        error = f"{type(e).__name__}: {e}"
                        time.sleep(wait * 2**n if n < retries - 1 else 0)
                yield pd.DataFrame([(url, content, error)], columns=["url", "content", "error"])

    rows = urls.select("url")
    return (rows.repartition(tasks) if tasks else rows).mapInPandas(read, "url string, content binary, error string")


def by_record(urls: DataFrame, recorded: DataFrame) -> DataFrame:
    """(url, content, error) from recorded contents (url, content), one for each url; a url without one is an error."""
    got = recorded.select("url", F.col("content").cast("binary").alias("content"))
    return urls.select("url").join(got, "url", "left").withColumn("error", F.when(F.col("content").isNull(), "not recorded"))


def mime(content: Column) -> Column:
    """A kind by the first bytes."""
    head = F.decode(F.substring(content, 1, 512), "ISO-8859-1")
    return F.when(F.startswith(head, F.lit("%PDF")), "application/pdf").when(F.lower(head).rlike(r"^\s*<(!doctype|html|\?xml|head|body)"), "text/html").otherwise("text/plain")


class FetchStore:
    """Contents and what came of urls, in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str, n_buckets: int = 64) -> None:
        self._spark = spark
        self._objects = ReleaseTable(spark, f"{path}/objects", "document_id", n_buckets)
        self._fetched = ReleaseTable(spark, f"{path}/fetched", "url", n_buckets)

    def _table(self, table: ReleaseTable, ddl: str) -> DataFrame:
        return table.read() if table.version().number >= 0 else self._spark.createDataFrame([], ddl)

    @property
    def objects(self) -> DataFrame:
        return self._table(self._objects, OBJECTS)

    @property
    def fetched(self) -> DataFrame:
        return self._table(self._fetched, FETCHED)

    def pending(self, candidates: DataFrame) -> DataFrame:
        """(url): candidates' distinct urls that nothing has come of yet; empty and null ones are none."""
        urls = candidates.where("url <> ''").select("url").distinct()
        return urls.join(self.fetched.where("ok").select("url"), "url", "left_anti")

    def fetch(self, candidates: DataFrame, get: Callable[[DataFrame], DataFrame]) -> int:
        """Get what is pending by ``get`` (urls -> url, content, error) and store it; returns how many urls were asked for.

        ``get`` is run once: its rows are written first, and read from there.
        """
        urls = self.pending(candidates)
        n = urls.count()
        if not n:
            return 0
        got = get(urls).withColumns({"document_id": F.sha2("content", 256), "n_bytes": F.octet_length("content").cast("long")})
        got = self._fetched.staged(got)
        # each content once: copies are told by their ids, and the bytes of one of them are taken
        one = got.where("content is not null").groupBy("document_id").agg(F.min("url").alias("url")).join(self.objects.select("document_id"), "document_id", "left_anti")
        new = got.join(one, ["document_id", "url"], "left_semi").select("document_id", "content", "n_bytes", mime(F.col("content")).alias("mime"))
        self._objects.append(new)
        was = self.fetched.select("url", F.col("tries").alias("_was"))
        rows = got.join(was, "url", "left").select(
            "url", F.col("content").isNotNull().alias("ok"), "document_id", F.when(F.col("content").isNull(), F.coalesce("error", F.lit("no content"))).alias("error"),
            (F.coalesce("_was", F.lit(0)) + 1).cast("int").alias("tries"),
        )
        self._fetched.merge(rows, rows.select("url"))
        self._fetched.clear()
        return n
