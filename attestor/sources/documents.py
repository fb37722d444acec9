"""Document bytes and texts: files, precomputed texts, and pages by a pluggable reader."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.functions.exprs import first_of
from attestor.operators.text import page_marked

TEXT_CACHE = "url string, ok boolean, document_id string, text string, n_pages int, scanned boolean, error string"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, document_id, mime, n_bytes, content): each file's bytes under the hash that names them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    mime = F.when(F.endswith(F.lower("path"), F.lit(".txt")), "text/plain").otherwise("application/pdf")
    return files.select("path", F.sha2("content", 256).alias("document_id"), mime.alias("mime"), F.col("length").alias("n_bytes"), "content")


def new_files(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Files whose bytes aren't stored yet, each content once."""
    return files.join(stored.select("document_id").distinct(), "document_id", "left_anti").dropDuplicates(["document_id"])


def plain_texts(files: DataFrame) -> DataFrame:
    """(document_id, text): text files as one marked page."""
    body = F.decode("content", "UTF-8")
    return files.where("mime = 'text/plain'").select("document_id", page_marked(F.lit(1), body).alias("text"))


def page_texts(files: DataFrame, reader: Callable[[bytes], list[str]], partitions: int | None = None) -> DataFrame:
    """(document_id, page_no, body, error) by a reader of bytes; a document that fails is a row with its error.

    The reader runs in tasks; ``partitions`` spreads few large files.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, content in batch.itertuples(index=False):
                try:
                    rows += [(doc, i, body.strip(), None) for i, body in enumerate(reader(bytes(content)), 1)]
                except Exception as e:  # one bad document must not end the run
                    rows.append((doc, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["document_id", "page_no", "body", "error"]).astype({"page_no": "Int32"})

    few = files.select("document_id", "content")
    return (few.repartition(partitions) if partitions else few).mapInPandas(read, "document_id string, page_no int, body string, error string")


def text_cache(spark: SparkSession, path: str) -> DataFrame:
    """(url, document_id, text) of usable precomputed texts (JSON lines); the last of equal urls counts."""
    rows = spark.read.schema(TEXT_CACHE).json(path).where("ok and url <> '' and text <> ''")
    last = rows.withColumn("_at", F.struct(F.input_file_name(), F.monotonically_increasing_id()))
    return last.groupBy("url").agg(F.max_by(F.struct("document_id", "text"), "_at").alias("r")).select("url", "r.*")


def attach_texts(candidates: DataFrame, cached: DataFrame, local: DataFrame) -> DataFrame:
    """Candidates with document_id and text: from the cache by url, else from a local file by path."""
    c = cached.select(F.col("url").alias("_u"), F.col("document_id").alias("_d1"), F.col("text").alias("_t1"))
    f = local.select(F.col("local_path").alias("_p"), F.col("document_id").alias("_d2"), F.col("text").alias("_t2"))
    flat = [n for n, t in candidates.dtypes if not t.startswith(("map", "array", "struct", "variant"))]
    # rows that name nothing match nothing: they are dealt by all that they hold, so that no task gets all of them
    dealt = lambda key: F.coalesce(key, F.concat(F.lit("\0"), F.xxhash64(*flat)))
    meets = lambda key, named: key.isNotNull() & (dealt(key) == named)
    out = candidates.join(c, meets(F.col("url"), F.col("_u")), "left").join(f, meets(F.col("local_path"), F.col("_p")), "left")
    out = out.withColumns({"document_id": first_of(F.col("_d1"), F.col("_d2")), "text": first_of(F.col("_t1"), F.col("_t2")), "source_url": F.col("location")})
    return out.drop("_u", "_d1", "_t1", "_p", "_d2", "_t2")
