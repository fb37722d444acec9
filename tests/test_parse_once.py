"""Rule-based parsing cuts a line once, whatever is asked of its records."""

from pyspark.sql import functions as F

from attestor.operators import extract, text
from attestor.plans.datasets import dataset


def test_lines_are_cut_once_below_filters(spark):
    body = "Hospital: H\nState: OH\n== IDENTIFIED NEEDS ==\nNeed: a | Rank: 1 | need: b\nNeed: c | Rank: x\nno pair\n== OTHER ==\nNeed: d"
    docs = spark.range(1).select(F.col("id").alias("ordinal"), *[F.lit("d" if c == "document_id" else None).cast("string").alias(c) for c in extract.DOCUMENT[:-1]], F.lit(2024).alias("report_year"), F.lit(body).alias("text"))
    good, bad = extract.quarantine(extract.parse_rules(docs.repartition(2), dataset("chna")), dataset("chna"))
    assert [(r.need, r.priority_rank) for r in good.orderBy("record_seq").collect()] == [("b", 1), ("c", None)]
    assert not bad.count()
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 2  # keys and values


def test_key_values_of_odd_lines(spark):
    lines = ["a: 1 | A: 2 | b : ", "", "x", None, ": v | k:w"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = {r.i: r.m for r in rows.select("i", text.key_values(F.col("line"), r"([A-Za-z /]+):\s*([^|]+)").alias("m")).collect()}
    assert got == {0: {"a": "2"} | got[0], 1: {}, 2: {}, 3: None, 4: got[4]}
    assert got[0]["a"] == "2" and got[4]["k"] == "w"


def test_rows_without_url_are_dealt_over_tasks(spark):
    from attestor.sources.documents import attach_texts

    n = F.col("id")
    rows = spark.range(400).select(n, F.when(n % 4 == 0, n.cast("string")).alias("url"), F.lit(None).cast("string").alias("local_path"), F.lit("x").alias("location"))
    cached = spark.range(400).select(n.cast("string").alias("url"), F.concat(F.lit("c"), n).alias("document_id"), F.lit("t").alias("text"))
    local = cached.where("url is null").withColumnRenamed("url", "local_path")
    auto = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in auto}
    for k, v in auto.items():
        spark.conf.set(k, v)
    try:
        out = attach_texts(rows, cached, local).withColumn("_task", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(r.id for r in out if r.text) == list(range(0, 400, 4)) and len(out) == 400
    assert max(sum(r._task == t for r in out) for t in range(4)) < 200
