"""Model extractors: a provider answers chunks or figure pages; Spark's tasks are the fan-out.

A provider is any callable from a text (and page image where there is one) to an answer's text.  It is
called in tasks, retried there, and a chunk that fails for good is a row with its error, so no chunk
ends a run.  Recorded answers join instead of calls (``answers_from``).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Provider = Callable[[str | bytes], str]
ANSWERS = "custom_id string, status string, answer string, error string"


def call_provider(requests: DataFrame, provider: Provider, tasks: int | None = None, retries: int = 5, wait: float = 1.0, of: str = "chunk") -> DataFrame:
    """(custom_id, status, answer, error) for every request (custom_id, and ``of``: a text or an image's bytes); waits double between tries."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, chunk in batch.itertuples(index=False):
                error = None
                for n in range(retries):
                    try:
                        rows.append((key, "succeeded", provider(bytes(chunk) if isinstance(chunk, (bytes, bytearray, memoryview)) else chunk), None))
                        break
                    except Exception as e:  # whatever a provider raises is worth a retry
                        error = f"{type(e).__name__}: {e}"
                        time.sleep(wait * 2**n if n < retries - 1 else 0)
                else:
                    rows.append((key, "errored", None, error))
            yield pd.DataFrame(rows, columns=["custom_id", "status", "answer", "error"])

    rows = requests.select("custom_id", of)
    return (rows.repartition(tasks) if tasks else rows).mapInPandas(call, ANSWERS)


def answers_from(requests: DataFrame, recorded: DataFrame) -> DataFrame:
    """Recorded answers of the requests; a request without one is ``missing``."""
    got = recorded.select("custom_id", "answer", F.lit(True).alias("_got"))
    out = requests.select("custom_id").join(got, "custom_id", "left")
    return out.select("custom_id", F.when(F.col("_got"), "succeeded").otherwise("missing").alias("status"), "answer")


def pending(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests that no answer has succeeded for: what a resumed run still has to ask."""
    return requests.join(answers.where("status = 'succeeded'").select("custom_id").distinct(), "custom_id", "left_anti")


def escalate(first: DataFrame, second: DataFrame, empty: str = "{}") -> DataFrame:
    """The first model's answer, or the second's where the first gave none."""
    none = F.coalesce(F.col("a.answer"), F.lit("")).isin("", empty)
    joined = first.alias("a").join(second.alias("b"), F.col("a.custom_id") == F.col("b.custom_id"), "left")
    return joined.select(F.col("a.custom_id").alias("custom_id"), F.when(none, F.col("b.answer")).otherwise(F.col("a.answer")).alias("answer"), none.alias("escalated"))


def blocks(requests: DataFrame, size: int = 90_000, n: int | None = None) -> DataFrame:
    """Requests with ``block``: batches of at most about ``size``, by hash, for services that take batches.

    ``n`` is the number of requests where that is known; else they are counted.
    """
    of = lambda count: F.greatest(F.lit(1), F.ceil(count / size)).cast("int")
    if n is not None:
        return requests.withColumn("block", F.pmod(F.xxhash64("custom_id"), of(F.lit(n))).cast("int"))
    out = requests.crossJoin(F.broadcast(requests.agg(of(F.count(F.lit(1))).alias("_n"))))  # one row
    return out.withColumn("block", F.pmod(F.xxhash64("custom_id"), F.col("_n")).cast("int")).drop("_n")
