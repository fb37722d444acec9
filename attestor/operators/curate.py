"""Curated outputs: flat tables, lossless records, manifests and descriptions."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.operators.extract import PROVENANCE, all_fields
from attestor.operators.verify import FLAGS
from attestor.plans.datasets import KINDS, Dataset

BASE = (("qa_status", "string"), ("trust_score", "double"), ("review_recommended", "boolean"))


def record_ddl(ds: Dataset) -> str:
    """The schema of a dataset's wide record table."""
    own = [f"{f} {t}" for f, t in all_fields(ds).items()]
    seq = "record_seq struct<document:bigint,item:bigint,part:int>"
    return ", ".join(["record_type string", seq, *own, f"provenance {PROVENANCE}", f"qa_flags {FLAGS}", *[f"{n} {t}" for n, t in BASE]])


def joined_flags(flags: Column) -> Column:
    return F.array_join(F.transform(flags, lambda f: f["msg"]), "; ")


def flatten(records: DataFrame, kind: str) -> DataFrame:
    """A kind's flat table: own fields, base fields, provenance as ``prov_*``, flags joined."""
    rows = records.where(F.col("record_type") == kind)
    base = [n for n, _ in BASE if n in records.columns]
    prov = [F.col(f"provenance.{n}").alias(f"prov_{n}") for n in records.schema["provenance"].dataType.names]
    return rows.select(*KINDS[kind].fields, *base, *prov, joined_flags(F.col("qa_flags")).alias("qa_flags"))


def table_counts(records: DataFrame) -> DataFrame:
    """(table, n): rows of each table; an unknown type is its own table."""
    names = F.create_map(*[F.lit(x) for k in KINDS.values() for x in (k.name, k.table)])
    return records.groupBy(F.coalesce(F.try_element_at(names, F.col("record_type")), F.col("record_type")).alias("table")).agg(F.count(F.lit(1)).alias("n"))


def curate(records: DataFrame, documents: DataFrame, out: str, ds: Dataset, parquet: bool = True) -> dict:
    """Write the tables that have rows, all records as JSON lines, and the documents; return the counts."""
    counts = {r.table: r.n for r in table_counts(records).collect()}  # at most one row a kind
    for kind in ds.kinds:
        table = KINDS[kind].table
        if counts.get(table):
            flat = flatten(records, kind)
            flat.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(f"{out}/{table}.csv")
            if parquet:
                flat.write.mode("overwrite").parquet(f"{out}/{table}.parquet")
    records.select(F.to_json(F.struct(*[c for c in records.columns if c != "signals"])).alias("value")).write.mode("overwrite").text(f"{out}/records.jsonl")
    documents.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(f"{out}/documents.csv")
    return {"tables": counts, "n_documents": documents.count(), "parquet": parquet}


def file_digests(files: DataFrame, chunk: int = 1 << 23) -> DataFrame:
    """(path, sha256) of files (path): each is read in pieces of ``chunk`` bytes by one task, so none has to fit in memory.

    Files are opened by the scheme of their path (local, HDFS, S3, GCS).  Spark lists no empty files.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        for batch in batches:
            for path in batch["path"]:
                fs, name = FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                digest = hashlib.sha256()
                with fs.open_input_stream(name) as f:
                    while piece := f.read(chunk):
                        digest.update(piece)
                yield pd.DataFrame([(path, digest.hexdigest())], columns=["path", "sha256"])

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(n, "path").mapInPandas(read, "path string, sha256 string")


def manifest(spark: SparkSession, path: str, dataset_id: str, version: str, license_name: str) -> str:
    """MANIFEST.json's text: name, bytes, SHA-256 and rows (of tables, else null) of every file of a release folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    digests = file_digests(files).withColumnRenamed("path", "_file")
    rows = files.select("path", F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("name"), F.col("length").alias("bytes")).join(digests, F.col("path") == F.col("_file")).drop("_file")
    table = lambda end, kind, **more: (
        spark.read.format(kind).schema("value string").options(recursiveFileLookup=True, pathGlobFilter=f"*{end}", **more).load(path)
        .groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count(F.lit(1)).alias("rows"))
    )
    counted = table(".csv", "csv", header=True, multiLine=True).unionByName(table(".txt", "text")).unionByName(table(".parquet", "parquet"))
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    rows = rows.join(counted, plain("path") == plain("_path"), "left").drop("path", "_path")
    listed = [r.asDict() for r in rows.where("name not like '%MANIFEST.json'").orderBy("name").collect()]  # one row a file
    return json.dumps({"dataset": dataset_id, "software_version": version, "license": license_name, "files": listed}, indent=2)


def data_dictionary(ds: Dataset) -> str:
    """Markdown of every table's columns and types."""
    out = [f"# Data dictionary: {ds.name}", ""]
    for kind in (KINDS[k] for k in ds.kinds):
        out += [f"## {kind.table}", "", "| column | type |", "|---|---|"]
        out += [f"| {f} | {t if f in kind.required else t + ' or null'} |" for f, t in kind.fields.items()]
        out += ["| trust_score | double or null |", "| review_recommended | boolean |", ""]
    return "\n".join(out)


def dataset_card(ds: Dataset, counts: dict[str, int], summary: dict) -> str:
    """Markdown card: tables with row counts, and the verification summary."""
    rows = [f"| {t} | {n} |" for t, n in sorted(counts.items())]
    facts = [f"- {k}: {v}" for k, v in summary.items()]
    return "\n".join([f"# {ds.name}", "", "| table | rows |", "|---|---|", *rows, "", "## Verification", "", *facts, ""])


def croissant(ds: Dataset, counts: dict[str, int], url: str, license_name: str) -> str:
    """JSON-LD of the dataset: a file object and a record set for each table."""
    tables = [KINDS[k] for k in ds.kinds if counts.get(KINDS[k].table)]
    files = [{"@type": "cr:FileObject", "@id": f"{t.table}.csv", "name": f"{t.table}.csv", "encodingFormat": "text/csv"} for t in tables]
    sets = [
        {"@type": "cr:RecordSet", "name": t.table, "field": [{"@type": "cr:Field", "name": f, "source": {"fileObject": {"@id": f"{t.table}.csv"}, "extract": {"column": f}}} for f in (*t.fields, "prov_source_document_id")]}
        for t in tables
    ]
    body = {"@context": {"@vocab": "https://schema.org/", "cr": "http://mlcommons.org/croissant/"}, "@type": "Dataset", "name": ds.name, "url": url, "license": license_name, "distribution": files, "recordSet": sets}
    return json.dumps(body, indent=2)
