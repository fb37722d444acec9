"""Command line: list, run, sample, evaluate, agreement and batch."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.operators import evaluate as ev
from attestor.operators import extract
from attestor.plans import pipeline
from attestor.plans.datasets import DATASETS, KINDS, dataset
from attestor.sources import documents, registry, releases

#: Rows printed as an example where the whole is written as a table.
EXAMPLES = 10


def _session() -> SparkSession:
    return SparkSession.builder.appName("attestor").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _documents(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Candidates of the registry with their texts: cached ones, else local text files."""
    found = registry.discover(registry.load_sources(spark, args.dataset, args.registry), args.dataset, args.limit)
    files = documents.read_files(spark, args.files)
    names = files.select("document_id", F.regexp_extract("path", r"([^/]+)$", 1).alias("local_path"))
    local = documents.plain_texts(files).join(names, "document_id")
    empty = spark.createDataFrame([], "url string, document_id string, text string")
    cached = documents.text_cache(spark, args.texts) if args.texts else empty
    rows = documents.attach_texts(found.withColumn("local_path", F.regexp_extract(F.coalesce("local_path", F.lit("")), r"([^/]+)$", 1)), cached, local)
    seq = F.col("candidate_seq.ordinal") * 100_000 + F.col("candidate_seq._n")
    return rows.where("text is not null").select(seq.cast("long").alias("ordinal"), *extract.DOCUMENT, "text")


def _payloads(spark: SparkSession, path: str | None, docs: DataFrame, pages: bool = False) -> DataFrame | None:
    """Recorded answers (JSON lines: document_id, chunk_index, answer; page_no for figure pages) as payloads of their documents."""
    if not path:
        return None
    rows = spark.read.schema("document_id string, chunk_index int, page_no int, answer string").json(path)
    if not pages:
        rows = rows.drop("page_no")
    rows = rows.withColumn("chunk_index", F.coalesce("chunk_index", "page_no" if pages else F.lit(0)))
    rows = rows.withColumn("payload", extract.salvage_json(F.col("answer"))).where("payload is not null")
    return rows.join(docs.select("ordinal", *extract.DOCUMENT), "document_id")


def run(args: argparse.Namespace) -> dict:
    spark, ds = _session(), dataset(args.dataset)
    docs = _documents(spark, args)
    other = _payloads(spark, args.second, docs)
    second = None if other is None else extract.payload_records(other, ds)
    result = pipeline.run(docs, ds, _payloads(spark, args.answers, docs, args.extractor == "vision"), second, args.extractor)
    return pipeline.publish(result, ds, args.out, not args.no_parquet)


def batch(args: argparse.Namespace) -> dict:
    spark, ds = _session(), dataset(args.dataset)
    docs = _documents(spark, args)
    wave = pipeline.run(docs, ds, _payloads(spark, args.answers, docs, args.extractor == "vision"), extractor=args.extractor)
    if args.merge:
        old, old_docs = releases.load_release(spark, args.merge, ds)
        kinds = dict(wave.documents.dtypes)
        wave = pipeline.merge_wave(old, old_docs.select(*[F.col(c).try_cast(kinds.get(c, "string")).alias(c) for c in old_docs.columns]), wave)
    return pipeline.publish(wave, ds, args.out, not args.no_parquet)


def sample(args: argparse.Namespace) -> dict:
    spark, ds = _session(), dataset(args.dataset)
    rows = releases.load_predictions(spark, args.release, ds)
    by = args.stratify or ds.identity[0]
    chosen = ev.stratified_sample(rows, args.n, by, "row_uid", args.seed)
    ev.gold_sheet(chosen, list(ds.identity), list(ds.ensemble_fields)).coalesce(1).write.mode("overwrite").option("header", True).csv(args.out)
    return {"dataset": ds.id, "sampled": chosen.count(), "stratify": by, "out": args.out}


def evaluate(args: argparse.Namespace) -> dict:
    spark, ds = _session(), dataset(args.dataset)
    gold = spark.read.option("header", True).csv(args.gold)
    parts = ev.evaluate(gold, releases.load_predictions(spark, args.release, ds), args.alpha, args.delta, args.stratify or ds.identity[0])
    report = {**parts["accuracy"].first().asDict(), **parts["threshold"].first().asDict(), **parts["accepted"].first().asDict()}
    report["stratified_thresholds"] = {r.stratum: r.threshold for r in parts["stratified_thresholds"].collect()}  # one row a stratum
    if args.curve:
        parts["risk_coverage"].write.mode("overwrite").option("header", True).csv(args.curve)
    return report


def agreement(args: argparse.Namespace) -> dict:
    spark = _session()
    a, b = releases.load_labels(spark, args.a), releases.load_labels(spark, args.b)
    report = ev.agreement(a, b).first().asDict()
    if not report["n_overlap"]:
        print(json.dumps({"n_overlap": 0, "note": "no row_uids labelled by both reviewers"}))
        sys.exit(1)
    rows = ev.disagreements(a, b)
    if not args.out:  # every one, as the sheets of two reviewers give them
        uids = [r.row_uid for r in rows.toLocalIterator()]
        return report | {"n_disagreements": len(uids), "disagreement_row_uids": uids}
    rows.write.mode("overwrite").option("header", True).csv(args.out)
    examples = [r.row_uid for r in rows.limit(EXAMPLES).collect()]
    return report | {"n_disagreements": rows.count(), "disagreements": args.out, "disagreement_examples": examples}


def listing(args: argparse.Namespace) -> dict:
    return {d.id: {"name": d.name, "tables": [KINDS[k].table for k in d.kinds]} for d in DATASETS.values()}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="attestor")
    sub = p.add_subparsers(required=True)

    def command(name, f, *options):
        c = sub.add_parser(name)
        c.set_defaults(f=f)
        for flag, kind in options:
            c.add_argument(flag, **kind)

    need, text = {"required": True}, {}
    source = [("--dataset", need), ("--registry", need), ("--files", need), ("--texts", text), ("--answers", text), ("--extractor", {"choices": sorted(extract.EXTRACTORS)}), ("--limit", {"type": int}), ("--no-parquet", {"action": "store_true"}), ("--out", need)]
    command("list", listing)
    command("run", run, *source, ("--second", text))
    command("batch", batch, *source, ("--merge", text))
    command("sample", sample, ("--dataset", need), ("--release", need), ("--n", {"type": int, "default": 100}), ("--stratify", text), ("--seed", {"type": int, "default": 0}), ("--out", need))
    command("evaluate", evaluate, ("--dataset", need), ("--release", need), ("--gold", need), ("--alpha", {"type": float, "default": 0.05}), ("--delta", {"type": float, "default": 0.05}), ("--stratify", text), ("--curve", text))
    command("agreement", agreement, ("--a", need), ("--b", need), ("--out", text))
    return p


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    print(json.dumps(args.f(args), default=str))


if __name__ == "__main__":
    main()
