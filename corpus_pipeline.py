"""A corpus pipeline of five stages: language ID, near-duplicate join, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``, whatever other columns these have.  Between stages the documents are written as Parquet and read
again.  An empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.llm import decontaminate, language_id, mixing, ngram_join, sharding
from attestor.llm.scratch import materialize

#: SQL cannot express the trained and the iterative stages; tests hold them against brute force.
ORACLE_SQL = None

SHARDS = 24


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised; learnt from rows that are not held out.

    Documents of null text or without a letter go, as do those whose best language has a probability below 0.4.
    Rows of null id are not learnt from.  Repeated rows are judged one by one.  With nothing to learn from, or an empty
    table, nothing is kept.
    """
    learnt = docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2)
    return language_id.keep_known(docs, language_id.fit(learnt))


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, of least doc_id, of each class of near duplicates.

    Every text of an id is a document of its own; of several of the least id in a class that of least hash stays.  Rows
    of equal id and text count once.  Documents without words are classes of their own; those of null id stay.
    """
    return ngram_join.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that are not contaminated by the benchmark.

    Null texts have no words and stay, as does every row where the benchmark is empty or its texts are null.  Rows of
    equal content are judged alike.
    """
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies of each document, as many as the mix takes, rounded; no copy where it takes less than half.

    Null and empty texts have no words and are not taken; a null source is one of its own.  Texts that share an id, or
    have none, are counted apart; of equal rows each is taken as often, and what a demand leaves over goes to one.
    """
    return mixing.take(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``shard`` (0 to 23, near equal bytes) and ``slot`` in it.

    Null texts have no bytes but their overhead.  Repeated rows each have a slot; equal texts share a shard as long as
    they fill a quarter of one at most.  Columns that are called like a result are replaced.
    """
    return sharding.shard_documents(docs, SHARDS)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", join_near_duplicates),
    ("benchmark decontamination", decontaminate_benchmark),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{k}")
    return docs
