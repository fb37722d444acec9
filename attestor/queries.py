"""Queries that run each operator over the driver's tables, and the SQL that they must equal.

``measures`` views line items as quality-measure records: states are nations, plans suppliers,
measures brands.  Canonical texts and payloads are composed from customers, some fifty a document, so
that what the parsers find can be stated in SQL over the tables themselves.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.functions import exprs as E
from attestor.functions import intervals as I
from attestor.operators import analysis, curate, evaluate, extract, gate, merge, reconcile, text, verify
from attestor.operators.constraints import subgroup_within_overall
from attestor.plans import pipeline
from attestor.plans.datasets import dataset
from attestor.sources import links

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---------------------------------------------------------------- records from line items

EQR = dataset("eqr")
KEYS = list(EQR.ensemble_key)
SEQ = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


def measures(spark: SparkSession, sf: str) -> DataFrame:
    li, s, n, p = (table(spark, sf, t) for t in ("lineitem", "supplier", "nation", "part"))
    rows = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    odd = F.col("l_linenumber") % 4 == 0
    return rows.select(
        F.lit("eqr_quality_measure").alias("record_type"), F.struct(*SEQ).alias("record_seq"), "l_orderkey", "l_linenumber",
        F.col("n_name").alias("state"), F.col("s_name").alias("plan_name"), F.col("p_brand").alias("measure_name"), F.lit("Unknown").alias("measure_steward"),
        F.when(~odd, F.col("l_returnflag")).alias("population"), F.year("l_shipdate").alias("reporting_year"), (F.col("l_discount") * 1000).alias("rate"),
        F.lit("percent").alias("rate_unit"), F.when(~odd, F.col("l_quantity").cast("int")).alias("numerator"), F.col("p_size").cast("int").alias("denominator"),
        F.array().cast(verify.FLAGS).alias("qa_flags"),
    )


def second_reading(r: DataFrame) -> DataFrame:
    """Another extraction: two thirds of the records, some rates moved."""
    moved = F.when(F.col("l_linenumber") % 2 == 0, F.col("rate") + 5).otherwise(F.col("rate"))
    return r.where(F.col("l_orderkey") % 3 != 0).withColumn("rate", moved)


R_SQL = """
WITH R AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, n_name AS state, s_name AS plan_name,
    p_brand AS measure_name, CASE WHEN l_linenumber % 4 <> 0 THEN l_returnflag END AS population, CAST(year(l_shipdate) AS INTEGER) AS reporting_year,
    l_discount * 1000 AS rate, CASE WHEN l_linenumber % 4 <> 0 THEN CAST(l_quantity AS INTEGER) END AS numerator, CAST(p_size AS INTEGER) AS denominator
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
AX AS (SELECT *, CASE WHEN numerator IS NOT NULL THEN numerator <= denominator END AS a1, denominator > 0 AS a2, rate BETWEEN 0 AND 100 AS a3,
    CASE WHEN numerator IS NOT NULL AND denominator <> 0 THEN abs(100.0e0 * numerator / denominator - rate) <= 1 END AS a4,
    count(*) OVER (PARTITION BY state, plan_name, measure_name, population, reporting_year) AS grain FROM R),
SC AS (SELECT *, CAST(coalesce(NOT a1, false) AS INT) + CAST(coalesce(NOT a2, false) AS INT) + CAST(coalesce(NOT a3, false) AS INT) AS hard,
    CAST(coalesce(NOT a4, false) AS INT) + CAST(grain > 1 AS INT) AS soft FROM AX),
TR AS (SELECT *, CASE WHEN hard > 0 THEN 0.0e0 ELSE round(exp(2 * soft * ln(0.75e0) / 3), 4) END AS trust,
    CASE WHEN hard > 0 THEN 'fail' WHEN soft > 0 THEN 'warn' ELSE 'pass' END AS qa FROM SC)
"""
KEY_EQ = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in KEYS)
R2_SQL = R_SQL + f""",
S AS (SELECT * FROM (SELECT {', '.join(KEYS)}, numerator, denominator, CASE WHEN l_linenumber % 2 = 0 THEN rate + 5 ELSE rate END AS rate,
    row_number() OVER (PARTITION BY {', '.join(KEYS)} ORDER BY {', '.join(c + ' DESC' for c in SEQ)}) AS nth
    FROM R WHERE l_orderkey % 3 <> 0) WHERE nth = 1)
"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return verify.verify(measures(spark, sf), EQR.axioms())


@query(R_SQL + """SELECT count(*) AS n_records, count(*) FILTER (qa = 'pass') AS qa_pass, count(*) FILTER (qa = 'warn') AS qa_warn,
    count(*) FILTER (qa = 'fail') AS qa_fail, round(avg(trust), 4) AS mean_trust, round(min(trust), 4) AS min_trust,
    count(*) FILTER (qa = 'fail' OR trust < 0.85e0) AS review_recommended, count(*) FILTER (NOT (qa = 'fail' OR trust < 0.85e0)) AS auto_acceptable,
    CAST(0 AS BIGINT) AS ensemble_omissions FROM TR""")
def verify_summary(spark, sf):
    return verify.summarize(scored(spark, sf))


@query(R_SQL + "SELECT l_orderkey, l_linenumber, trust AS trust_score, qa AS qa_status, qa = 'fail' OR trust < 0.85e0 AS review_recommended FROM TR")
def trust_fusion(spark, sf):
    return scored(spark, sf).select("l_orderkey", "l_linenumber", "trust_score", "qa_status", "review_recommended")


@query(R_SQL + """SELECT l_orderkey, l_linenumber, CASE WHEN hard > 0 THEN 0.0e0 ELSE pow(0.75e0, soft) END AS score, hard = 0 AS ok,
    CAST(hard + soft AS BIGINT) AS n_violations FROM SC""")
def symbolic_scores(spark, sf):
    n = F.when(F.col("s.detail") == "all domain constraints satisfied", 0).otherwise(F.size(F.split("s.detail", "; ")))
    rows = scored(spark, sf).select("l_orderkey", "l_linenumber", F.col("signals")[0].alias("s"))  # the first is the axioms'
    return rows.select("l_orderkey", "l_linenumber", "s.score", "s.ok", n.cast("long").alias("n_violations"))


@query(R_SQL + """SELECT l_orderkey, l_linenumber, CAST(greatest(0, 1 - hard) AS DOUBLE) AS score, hard = 0 AS ok,
    CASE WHEN hard = 0 THEN 'no logical contradiction' ELSE 'logical contradiction; violated axiom(s): ' || concat_ws(', ',
    CASE WHEN NOT a1 THEN 'num_le_den' END, CASE WHEN NOT a2 THEN 'denominator_positive' END, CASE WHEN NOT a3 THEN 'percent_in_range' END) END AS detail FROM SC""")
def logic_validity(spark, sf):
    rows = scored(spark, sf).select("l_orderkey", "l_linenumber", F.col("signals")[1].alias("s"))  # the second is the logic's
    return rows.select("l_orderkey", "l_linenumber", "s.score", "s.ok", "s.detail")


@query("""WITH b AS (SELECT o_orderkey, (o_orderkey % 5) / 4.0e0 AS x, least(1.0e0, (o_orderkey % 5) / 4.0e0 + 0.25e0) AS y, (o_orderkey % 3) / 2.0e0 AS z FROM orders)
SELECT o_orderkey, greatest(0, x + z - 1) AS and_lower, greatest(0, y + z - 1) AS and_upper, least(1, x + z) AS or_lower, least(1, y + z) AS or_upper,
    1 - y AS not_lower, 1 - x AS not_upper, least(1, 1 - y + z) AS implies_lower, least(1, 1 - x + z) AS implies_upper FROM b""")
def logic_intervals(spark, sf):
    k = F.col("o_orderkey")
    a, b = I.interval(k % 5 / 4, F.least(F.lit(1.0), k % 5 / 4 + 0.25)), I.known(k % 3 / 2)
    both, any_, no, then = I.conjunction([a, b]), I.disjunction([a, b]), I.negate(a), I.implication(a, b)
    named = {"and": both, "or": any_, "not": no, "implies": then}
    return table(spark, sf, "orders").select("o_orderkey", *[v[s].alias(f"{n}_{s}") for n, v in named.items() for s in ("lower", "upper")])


@query(R_SQL + "SELECT state, plan_name, measure_name, population, reporting_year, CAST(grain AS BIGINT) AS n FROM AX WHERE grain > 1")
def duplicate_grain(spark, sf):
    # flags are built once a row: a filter on the array would be moved below them, with a copy of all that makes them
    flags = scored(spark, sf).select(*KEYS, F.inline_outer("qa_flags")).where(F.startswith("msg", F.lit("duplicate_grain")))
    return flags.select(*KEYS, F.regexp_extract("msg", r"x(\d+)\)", 1).cast("long").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN d = 0 OR (d <> 0 AND n > d) OR r NOT BETWEEN 0 AND 100 THEN 'fail' ELSE 'pass' END AS qa_status,
    concat_ws('; ', CASE WHEN d = 0 THEN 'denominator is zero' END, CASE WHEN d <> 0 AND n > d THEN 'numerator (' || n || ') > denominator (' || d || ')' END,
    CASE WHEN r NOT BETWEEN 0 AND 100 THEN 'percent rate out of [0,100]: ' || CAST(r AS VARCHAR) END) AS flags
    FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS n, CAST(l_suppkey % 40 AS INTEGER) AS d, CAST(l_linenumber * 20 AS DOUBLE) AS r FROM lineitem)""")
def construct_checks(spark, sf):
    r = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit("eqr_quality_measure").alias("record_type"), F.lit("tx").alias("state"), F.col("l_quantity").cast("int").alias("numerator"),
        (F.col("l_suppkey") % 40).cast("int").alias("denominator"), (F.col("l_linenumber") * 20).cast("double").alias("rate"), F.lit("percent").alias("rate_unit"), F.array().cast(verify.FLAGS).alias("qa_flags"),
    )
    return extract.normalize(r, EQR).select("l_orderkey", "l_linenumber", "qa_status", curate.joined_flags(F.col("qa_flags")).alias("flags"))


@query(R2_SQL + f"""SELECT a.l_orderkey, a.l_linenumber, CASE WHEN b.nth IS NULL THEN 0.5e0 ELSE (4 - CAST(dr AS INT) - CAST(dn AS INT) - CAST(dd AS INT)) / 4.0e0 END AS score,
    CASE WHEN b.nth IS NULL OR dr OR dn OR dd THEN NULL ELSE true END AS ok FROM (
    SELECT a.*, b.nth, NOT (abs(a.rate - b.rate) / greatest(abs(a.rate), abs(b.rate), 1e-9) <= 0.01e0) AS dr,
    CASE WHEN a.numerator IS NULL AND b.numerator IS NULL THEN false WHEN a.numerator IS NULL OR b.numerator IS NULL THEN true
      ELSE NOT (abs(a.numerator - b.numerator) / greatest(abs(a.numerator), abs(b.numerator), 1e-9) <= 0.01e0) END AS dn,
    NOT (abs(a.denominator - b.denominator) / greatest(abs(a.denominator), abs(b.denominator), 1e-9) <= 0.01e0) AS dd
    FROM R a LEFT JOIN S b ON {KEY_EQ}) a LEFT JOIN (SELECT 1) ON true""".replace("b.nth IS NULL", "nth IS NULL").replace("(\n    SELECT a.*, b.nth", "(\n    SELECT a.*, b.nth"))
def ensemble_signals(spark, sf):
    r = measures(spark, sf)
    e = F.col("_ensemble")
    return verify.reconcile(r, second_reading(r), KEYS, EQR.ensemble_fields).select("l_orderkey", "l_linenumber", e["score"].alias("score"), e["ok"].alias("ok"))


@query(R2_SQL + f"SELECT b.state, b.plan_name, b.measure_name, b.population, b.reporting_year FROM S b WHERE NOT EXISTS (SELECT 1 FROM R a WHERE a.l_orderkey % 2 = 0 AND {KEY_EQ})")
def ensemble_omissions(spark, sf):
    r = measures(spark, sf)
    return verify.omissions(r.where("l_orderkey % 2 = 0"), second_reading(r), KEYS).select(*KEYS)


DOC_SPAN_SQL = """WITH d AS (SELECT doc_id, text, CAST(doc_id % 50 AS INTEGER) AS numerator, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN left(text, 40)
    WHEN doc_id % 4 = 2 THEN 'No Such  Span ' || doc_id ELSE left(text, 60) END AS span FROM documents),
n AS (SELECT *, lower(trim(regexp_replace(replace(span, ',', ''), '\\s+', ' ', 'g'))) AS s, lower(trim(regexp_replace(replace(text, ',', ''), '\\s+', ' ', 'g'))) AS t FROM d)"""


@query(DOC_SPAN_SQL + """ SELECT doc_id, CASE WHEN span IS NULL OR span = '' THEN NULL WHEN NOT contains(t, s) THEN 0.0e0 WHEN NOT contains(s, CAST(numerator AS VARCHAR)) THEN 0.1e0 ELSE 1.0e0 END AS score,
    CASE WHEN span IS NULL OR span = '' THEN NULL ELSE contains(t, s) AND contains(s, CAST(numerator AS VARCHAR)) END AS ok FROM n""")
def grounding_check(spark, sf):
    k = F.col("doc_id") % 4
    span = F.when(k == 1, F.substring("text", 1, 40)).when(k == 2, F.concat(F.lit("No Such  Span "), "doc_id")).when(k == 3, F.substring("text", 1, 60))
    rows = table(spark, sf, "documents").select("doc_id", "text", (F.col("doc_id") % 50).cast("int").alias("numerator"), span.alias("span"))
    g = verify.grounding(rows.select("numerator"), F.col("span"), F.col("text"))
    return rows.select("doc_id", g["score"].alias("score"), g["ok"].alias("ok"))


@query("""WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN 'Overall' ELSE c_mktsegment END AS grp, CASE WHEN c_custkey % 5 <> 0 THEN CAST(floor(abs(c_acctbal)) AS INTEGER) END AS v FROM customer),
f AS (SELECT c_nationkey, min(c_custkey) AS k, arg_min(v, c_custkey) AS cap FROM c WHERE v IS NOT NULL AND grp = 'Overall' GROUP BY c_nationkey),
s AS (SELECT c_nationkey, sum(v) AS total FROM c GROUP BY c_nationkey)
SELECT c_custkey FROM c JOIN f USING (c_nationkey) JOIN s USING (c_nationkey) WHERE v IS NOT NULL AND CASE WHEN c_custkey = k THEN total - cap > cap ELSE v > cap END""")
def subgroup_le_overall(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    rows = c.select("c_custkey", F.col("c_nationkey").alias("state"), F.when(k % 7 == 0, "Overall").otherwise(F.col("c_mktsegment")).alias("grp"), F.when(k % 5 != 0, F.floor(F.abs("c_acctbal")).cast("int")).alias("v"), k.alias("record_seq"))
    a = subgroup_within_overall(F.lit(True), ("state",), "grp", "v", ("overall", "total", ""))
    return a.prepare(rows).withColumn("ok", a.outcome).where("ok = false").select("c_custkey")


# ---------------------------------------------------------------- calibration and labels


def judged(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents: a score from their length, correct where of good quality."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return d.select("doc_id", "lang", F.round(F.least(F.lit(1.0), F.col("n_chars") / 4000), 2).alias("score"), (F.col("quality") == 1).alias("correct"), F.col("doc_id").alias("record_seq"))


J_SQL = """WITH J AS (SELECT d.doc_id, lang, round(least(1.0e0, n_chars / 4000.0e0), 2) AS score, quality = 1 AS correct FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def _tau_sql(by: str) -> str:
    part = f"PARTITION BY {by} " if by else ""
    keys = f"{by}, " if by else ""
    return f"""{J_SQL}, G AS (SELECT {keys}score, count(*) AS n, count(*) FILTER (NOT correct) AS e FROM J GROUP BY {keys}score),
C AS (SELECT {keys}score, sum(n) OVER ({part}ORDER BY score DESC) AS n, sum(e) OVER ({part}ORDER BY score DESC) AS e FROM G),
TAU AS (SELECT {keys}min(score) FILTER (least(1.0e0, e / n + sqrt(ln(1 / 0.05e0) / (2 * n))) <= 0.3e0) AS threshold FROM C{f' GROUP BY {by}' if by else ''})"""


@query(_tau_sql("") + " SELECT threshold FROM TAU")
def conformal_threshold(spark, sf):
    return gate.thresholds(judged(spark, sf), 0.3, 0.05)


@query(_tau_sql("lang") + " SELECT lang, threshold FROM TAU")
def conformal_by_stratum(spark, sf):
    return gate.thresholds(judged(spark, sf), 0.3, 0.05, "lang")


@query(_tau_sql("lang") + f""", A AS ({_tau_sql('').replace('WITH J', 'WITH J2').replace('FROM J ', 'FROM J2 ')} SELECT threshold AS overall FROM TAU)
SELECT J.doc_id, NOT coalesce(J.score >= CASE WHEN J.lang = 'en' OR J.lang = 'fr' THEN TAU.threshold ELSE overall END, false) AS review_recommended
FROM J JOIN TAU ON J.lang = TAU.lang, A""")
def gate_annotate(spark, sf):
    j = judged(spark, sf)
    groups = gate.thresholds(j, 0.3, 0.05, "lang").where("lang in ('en', 'fr')")
    out = gate.annotate(j.withColumn("trust_score", F.col("score")), gate.thresholds(j, 0.3, 0.05), groups, "lang")
    return out.select("doc_id", "review_recommended")


@query(_tau_sql("") + """ SELECT count(*) AS n, count(*) FILTER (score >= threshold) AS auto_accepted, count(*) FILTER (NOT coalesce(score >= threshold, false)) AS sent_to_review,
    round(count(*) FILTER (score >= threshold) / CAST(count(*) AS DOUBLE), 4) AS coverage FROM J, TAU""")
def gate_summary(spark, sf):
    j = judged(spark, sf)
    return gate.summary(gate.annotate(j.withColumn("trust_score", F.col("score")), gate.thresholds(j, 0.3, 0.05)))


@query(J_SQL + """ SELECT row_number() OVER w AS rank, round(row_number() OVER w / CAST(count(*) OVER () AS DOUBLE), 3) AS coverage,
    round(sum(CAST(correct AS INT)) OVER w / CAST(row_number() OVER w AS DOUBLE), 4) AS accuracy, round(score, 4) AS trust_threshold FROM J
    WINDOW w AS (ORDER BY score DESC, doc_id ROWS UNBOUNDED PRECEDING)""")
def risk_coverage(spark, sf):
    return evaluate.risk_coverage(judged(spark, sf))


GOLD_SQL = J_SQL + """, P AS (SELECT substr(sha1(lower(trim(lang)) || '|' || CAST(doc_id AS VARCHAR)), 1, 16) AS uid, score, correct, doc_id FROM J),
G AS (SELECT CASE WHEN doc_id % 10 = 0 THEN 'none' || doc_id ELSE uid END AS uid, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE correct END AS correct FROM P),
M AS (SELECT G.uid, G.correct, P.score FROM G LEFT JOIN P ON G.uid = P.uid WHERE G.correct IS NOT NULL)"""


def _gold(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    j = judged(spark, sf).withColumn("row_uid", E.row_uid(["lang", "doc_id"]))
    k = F.col("doc_id")
    word = F.when(k % 6 == 0, "perhaps").when(F.col("correct"), F.when(k % 2 == 0, " Yes ").otherwise("1")).otherwise("incorrect")
    gold = j.select(F.when(k % 10 == 0, F.concat(F.lit("none"), k)).otherwise(F.col("row_uid")).alias("row_uid"), word.alias("correct"))
    return gold, j.select("row_uid", "record_seq", F.col("score").cast("string").alias("trust_score"), "lang")


@query(GOLD_SQL + """ SELECT n_labeled, n_unmatched_gold, n_correct, round(n_correct / CAST(n_labeled AS DOUBLE), 4) AS overall_accuracy,
    round(greatest(0, c - h), 4) AS ci_low, round(least(1, c + h), 4) AS ci_high FROM (SELECT *, (p + 3.8416e0 / (2 * n_labeled)) / (1 + 3.8416e0 / n_labeled) AS c,
    1.96e0 * sqrt(p * (1 - p) / n_labeled + 3.8416e0 / (4.0e0 * n_labeled * n_labeled)) / (1 + 3.8416e0 / n_labeled) AS h FROM (
    SELECT count(*) FILTER (score IS NOT NULL) AS n_labeled, count(*) FILTER (score IS NULL) AS n_unmatched_gold, count(*) FILTER (score IS NOT NULL AND correct) AS n_correct,
    count(*) FILTER (score IS NOT NULL AND correct) / CAST(count(*) FILTER (score IS NOT NULL) AS DOUBLE) AS p FROM M))""")
def accuracy_wilson(spark, sf):
    return evaluate.accuracy(evaluate.match_gold(*_gold(spark, sf)))


@query(GOLD_SQL + " SELECT uid AS row_uid, correct, score IS NOT NULL AS matched FROM M")
def gold_match(spark, sf):
    return evaluate.match_gold(*_gold(spark, sf)).select("row_uid", "correct", "matched")


def _reviewers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("row_uid"), "doc_id", (F.col("quality") == 1).alias("q"), (F.col("toxic") == 0).alias("t"))
    a = rows.where("doc_id % 5 <> 0").select("row_uid", F.when(F.col("q"), "y").otherwise("n").alias("correct"), F.col("doc_id").alias("record_seq"))
    b = rows.where("doc_id % 7 <> 0").select("row_uid", F.when(F.col("t"), "TRUE").otherwise("False").alias("correct"), F.col("doc_id").alias("record_seq"))
    return evaluate.labels(a), evaluate.labels(b)


AG_SQL = """WITH B AS (SELECT doc_id, quality = 1 AS x, toxic = 0 AS y FROM labels WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0)"""


@query(AG_SQL + """, C AS (SELECT count(*) AS n, count(*) FILTER (x AND y) AS bc, count(*) FILTER (NOT x AND NOT y) AS bi, count(*) FILTER (x AND NOT y) AS ab, count(*) FILTER (NOT x AND y) AS ba FROM B),
P AS (SELECT *, (bc + bi) / CAST(n AS DOUBLE) AS po, (bc + ab) / CAST(n AS DOUBLE) AS pa, (bc + ba) / CAST(n AS DOUBLE) AS pb FROM C)
SELECT n AS n_overlap, bc AS both_correct, bi AS both_incorrect, ab AS a_correct_b_incorrect, ba AS a_incorrect_b_correct, round(po, 4) AS percent_agreement,
    round((po - (pa * pb + (1 - pa) * (1 - pb))) / (1 - (pa * pb + (1 - pa) * (1 - pb))), 4) AS cohen_kappa,
    round((po - (pa + pb) * (1 - (pa + pb) / 2)) / (1 - (pa + pb) * (1 - (pa + pb) / 2)), 4) AS gwet_ac1 FROM P""")
def agreement_stats(spark, sf):
    return evaluate.agreement(*_reviewers(spark, sf))


@query(AG_SQL + " SELECT CAST(doc_id AS VARCHAR) AS row_uid FROM B WHERE x <> y")
def agreement_disagreements(spark, sf):
    return evaluate.disagreements(*_reviewers(spark, sf))


@query("""WITH s AS (SELECT lang AS stratum, count(*) AS size FROM documents GROUP BY lang)
SELECT stratum, size, CAST(least(size, greatest(1, round_even(100.0e0 * size / (SELECT sum(size) FROM s), 0))) AS BIGINT) AS share FROM s""")
def stratified_sample_sizes(spark, sf):
    return evaluate.stratum_sizes(table(spark, sf, "documents"), 100, "lang")


@query("""WITH s AS (SELECT lang, count(*) AS size FROM documents GROUP BY lang), t AS (SELECT CAST(least(size, greatest(1, round_even(100.0e0 * size / (SELECT sum(size) FROM s), 0))) AS BIGINT) AS share FROM s)
SELECT least(100, CAST(sum(share) AS BIGINT)) AS n FROM t""")
def stratified_sample(spark, sf):
    return evaluate.stratified_sample(table(spark, sf, "documents").select("doc_id", "lang"), 100, "lang", "doc_id", 7).agg(F.countDistinct("doc_id").alias("n"))


@query("SELECT doc_id, substr(sha1(lower(trim(lang)) || '|' || lower(trim(source)) || '|' || CAST(n_chars AS VARCHAR)), 1, 16) AS row_uid FROM documents")
def row_uids(spark, sf):
    return table(spark, sf, "documents").select("doc_id", E.row_uid(["lang", "source", "n_chars"]).alias("row_uid"))


# ---------------------------------------------------------------- texts


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS document_id FROM documents GROUP BY text")
def content_dedup(spark, sf):
    d = table(spark, sf, "documents").withColumn("document_id", F.sha2("text", 256))
    return text.first_by_content(d, "doc_id").select("doc_id", "document_id")


MARKED_SQL = r"""SELECT conv_id, string_agg(chr(10) || '[[PAGE ' || turn || ']]' || chr(10) || regexp_replace(text, '^\s+|\s+$', '', 'g') || chr(10), '' ORDER BY turn, text) AS text FROM conversations GROUP BY conv_id"""


def _marked(spark: SparkSession, sf: str) -> DataFrame:
    return text.marked_texts(table(spark, sf, "conversations"), "conv_id", "turn", "text")


@query(f"SELECT conv_id, sha256(text) AS text_sha256, CAST((length(text) - length(replace(text, '[[PAGE ', ''))) / 7 AS INTEGER) AS n_pages FROM ({MARKED_SQL})")
def page_mark_text(spark, sf):
    return _marked(spark, sf).select("conv_id", F.sha2("text", 256).alias("text_sha256"), text.page_count(F.col("text")).alias("n_pages"))


@query(f"""WITH RECURSIVE m AS ({MARKED_SQL}), p AS (SELECT conv_id, length(chr(10) || '[[PAGE ' || turn || ']]' || chr(10) || regexp_replace(text, '^\\s+|\\s+$', '', 'g') || chr(10)) AS n,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS i FROM conversations),
r AS (SELECT conv_id, i, n AS open, 1 AS chunk FROM p WHERE i = 1 UNION ALL
    SELECT p.conv_id, p.i, CASE WHEN r.open + p.n > 600 THEN p.n ELSE r.open + p.n END, CASE WHEN r.open + p.n > 600 THEN r.chunk + 1 ELSE r.chunk END FROM r JOIN p ON p.conv_id = r.conv_id AND p.i = r.i + 1)
SELECT conv_id, CAST(max(chunk) AS INTEGER) AS n_chunks, CAST(sum(n) AS BIGINT) AS n_chars FROM r JOIN p USING (conv_id, i) GROUP BY conv_id""")
def chunk_pack(spark, sf):
    c = text.chunks(F.col("text"), 600)
    return _marked(spark, sf).select("conv_id", F.size(c).alias("n_chunks"), F.length(F.array_join(c, "")).cast("long").alias("n_chars"))


@query("""SELECT DISTINCT 'd' || substr(sha1(sha256(text)), 1, 16) || '-c0' AS custom_id, sha256(text) AS document_id FROM documents""")
def chunk_requests(spark, sf):
    d = table(spark, sf, "documents").withColumn("document_id", F.sha2("text", 256))  # no page marks: one chunk each
    return text.requests(d, "doc_id").select("custom_id", "document_id")


@query("""SELECT p_partkey, trim(p_name) AS measure, CAST(p_size AS VARCHAR) || '%' AS rate, 'b: ' || p_brand AS note, CAST(4 AS INTEGER) AS n_keys FROM part""")
def kv_parse(spark, sf):
    line = F.concat(F.lit("Measure: "), "p_name", F.lit(" | RATE: 0% | Rate : x | Rate: "), F.col("p_size"), F.lit("% | Note: b: "), "p_brand", F.lit(" | Most Recent: 1"))
    kv = text.key_values(F.regexp_replace(line, r" \| Rate : x", ""), r"([A-Za-z /]+):\s*([^|]+)")
    got = lambda k: F.try_element_at("kv", F.lit(k))
    return table(spark, sf, "part").select("p_partkey", kv.alias("kv")).select("p_partkey", got("measure").alias("measure"), got("rate").alias("rate"), got("note").alias("note"), F.size("kv").alias("n_keys"))


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS asked FROM conversations""")
def header_carry_forward(spark, sf):
    c = table(spark, sf, "conversations").withColumn("_at", F.struct("turn", "role", "text"))
    return c.select("conv_id", "turn", text.carry(F.when(F.col("role") == "user", F.col("text")), text.carried(["conv_id"], "_at")).alias("asked"))


@query("""SELECT lang, count(DISTINCT md5(text || doc_id)) AS n_texts, CAST(sum(len(list_filter(string_split(text, chr(10)), lambda x: regexp_full_match(x, '\\s*') = false))) AS BIGINT) AS n_lines FROM documents GROUP BY lang""")
def text_lines(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    n = text.lines(d).groupBy("lang").agg(F.count(F.lit(1)).alias("n_lines"))
    return d.groupBy("lang").agg(F.countDistinct("doc_id").alias("n_texts")).join(n, "lang").select("lang", "n_texts", "n_lines")


@query("""SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY nd DESC, turn DESC) AS nth FROM (
    SELECT conv_id, turn, length(text) % 30 AS nd, length(text) % 3 AS ni FROM conversations WHERE turn % 2 = 0) WHERE ni > 0 OR nd >= 12) WHERE nth <= 2""")
def figure_page_gate(spark, sf):
    c, n = table(spark, sf, "conversations"), F.length("text")
    body = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("\n  Exhibit 4: "), "text")).otherwise(F.regexp_replace("text", r"(?i)figure|exhibit|chart", ""))
    pages = c.select("conv_id", "turn", F.col("turn").alias("page_no"), body.alias("body"), (n % 30).alias("n_drawings"), (n % 3).alias("n_images"))
    return text.figure_pages(pages, "conv_id", 2).select("conv_id", "turn")


# ---------------------------------------------------------------- printed values

PRINTED = "CASE o_orderkey % 8 WHEN 0 THEN '58.2%' WHEN 1 THEN '1,234' WHEN 2 THEN '12.5 per 1,000' WHEN 3 THEN '7 per 100,000' WHEN 4 THEN 'n/a' WHEN 5 THEN '-3' WHEN 6 THEN ' 41 percent ' ELSE '' END"
CLEAN = "replace(x, ',', '')"


@query(f"""SELECT o_orderkey, TRY_CAST(nullif(regexp_extract({CLEAN}, '-?\\d+(\\.\\d+)?'), '') AS DOUBLE) AS rate,
    CASE WHEN contains({CLEAN}, 'per 100000') THEN 'per_100000' WHEN contains({CLEAN}, 'per 1000') THEN 'per_1000' ELSE 'percent' END AS unit,
    CASE WHEN regexp_full_match(trim({CLEAN}), '[+-]?(\\d+(\\.\\d*)?|\\.\\d+)') THEN CAST(round_even(CAST({CLEAN} AS DOUBLE), 0) AS INTEGER) END AS number FROM (SELECT o_orderkey, {PRINTED} AS x FROM orders)""")
def printed_rates(spark, sf):
    x = F.expr(PRINTED)
    return table(spark, sf, "orders").select("o_orderkey", E.rate_value(x).alias("rate"), E.rate_unit(x).alias("unit"), E.to_int(x).alias("number"))


STEWARD = "CASE o_orderkey % 8 WHEN 0 THEN 'NCQA HEDIS' WHEN 1 THEN 'CMS Adult Core Set' WHEN 2 THEN 'child core' WHEN 3 THEN 'CAHPS 5.1' WHEN 4 THEN 'state-defined' WHEN 5 THEN 'Unknown' WHEN 6 THEN '' END"


@query(f"""SELECT o_orderkey, CASE WHEN x IS NULL OR x = '' THEN 'Unknown' WHEN contains(y, 'hedis') OR contains(y, 'ncqa') THEN 'HEDIS' WHEN contains(y, 'adult core') THEN 'Medicaid Adult Core Set'
    WHEN contains(y, 'child core') THEN 'Medicaid Child Core Set' WHEN contains(y, 'cahps') THEN 'CAHPS' WHEN contains(y, 'state') THEN 'State-defined' ELSE 'Other' END AS steward,
    CASE WHEN x IS NULL OR x = '' THEN NULL ELSE y IN ('yes', 'true', 'y', '1', 'priority') END AS flag FROM (SELECT o_orderkey, x, lower(x) AS y FROM (SELECT o_orderkey, {STEWARD} AS x FROM orders))""")
def printed_names(spark, sf):
    x = F.expr(STEWARD)
    return table(spark, sf, "orders").select("o_orderkey", E.steward(x).alias("steward"), E.to_bool(x).alias("flag"))


@query("SELECT p_partkey, printf('%g', p_retailprice) AS price, printf('%g', p_size * 100000.5e0) AS big, printf('%g', p_size / 1000000.0e0) AS small FROM part")
def short_numbers(spark, sf):
    g = E.short_number
    return table(spark, sf, "part").select("p_partkey", g(F.col("p_retailprice")).alias("price"), g(F.col("p_size") * 100000.5).alias("big"), g(F.col("p_size") / 1000000).alias("small"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN '0.4.1' ELSE CAST(s_suppkey % 3 AS VARCHAR) || '.' || CAST(s_suppkey % 7 AS VARCHAR) || '.' || CAST(s_suppkey + 1 AS VARCHAR) END AS next FROM supplier""")
def version_bump(spark, sf):
    k = F.col("s_suppkey")
    v = F.when(k % 5 == 0, "draft").otherwise(F.concat_ws(".", (k % 3).cast("string"), (k % 7).cast("string"), k.cast("string")))
    return table(spark, sf, "supplier").select("s_suppkey", E.bump_patch(v).alias("next"))


# ---------------------------------------------------------------- parsers, on texts composed from customers


def _composed(spark: SparkSession, sf: str, head: Column, line: Column) -> DataFrame:
    """Documents of at most 50 customers of a nation: its head, then a line a customer."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = c.groupBy("n_nationkey", "n_name", F.floor(F.col("c_custkey") / 50).alias("_part")).agg(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("l")))).alias("ls"))
    body = F.concat(head, F.array_join(F.transform("ls", lambda x: x["l"]), "\r\n"))
    null = F.lit(None).cast("string")
    return rows.select(
        (F.col("n_nationkey") + 100 * F.col("_part")).cast("long").alias("ordinal"), F.sha2(body, 256).alias("document_id"), F.lit("local").alias("source_url"), null.alias("jurisdiction"),
        F.lit("Care").alias("program"), F.lit("Pub").alias("publisher"), F.lit(2024).alias("report_year"), body.alias("text"), F.col("ls"), "n_name",
    )


CUST = "FROM customer JOIN nation ON c_nationkey = n_nationkey"


@query(f"""SELECT upper(n_name) AS state, 'Care' AS program, 'Plan ' || n_name AS plan_name, c_name || ': all' AS measure_name, CASE WHEN c_custkey % 2 = 0 THEN 'HEDIS' ELSE 'Unknown' END AS measure_steward,
    CAST(2023 AS INTEGER) AS reporting_year, (c_custkey % 1000) / 10.0e0 AS rate, CAST(1000 + c_custkey AS INTEGER) AS numerator, CAST(2000 AS INTEGER) AS denominator,
    CASE WHEN 1000 + c_custkey > 2000 THEN 'fail' ELSE 'pass' END AS qa_status {CUST}""")
def rule_parse_eqr(spark, sf):
    head = F.concat(F.lit("Report\nState: "), "n_name", F.lit("\nReporting Year: 2023\n\n== PERFORMANCE MEASURES ==\nPlan: Plan "), "n_name", F.lit("\n"))
    k = F.col("c_custkey")
    steward = F.when(k % 2 == 0, " | Steward: NCQA").otherwise("")
    line = F.concat(F.lit("Measure: "), "c_name", F.lit(": all"), steward, F.lit(" | Rate: "), ((k % 1000) / 10).cast("string"), F.lit("% | Numerator: "), F.format_number(1000 + k, 0), F.lit(" | Denominator: 2,000"))
    r = extract.parse_rules(_composed(spark, sf, head, line), EQR).where("record_type = 'eqr_quality_measure'")
    return r.select("state", "program", "plan_name", "measure_name", "measure_steward", "reporting_year", "rate", "numerator", "denominator", "qa_status")


@query(f"SELECT 'Hospital ' || n_name AS hospital_name, n_name AS state, CAST(2022 AS INTEGER) AS report_year, c_name AS need, c_mktsegment AS domain, c_custkey % 2 = 0 AS is_priority, CAST(c_custkey % 9 AS INTEGER) AS priority_rank {CUST}")
def rule_parse_chna(spark, sf):
    head = F.concat(F.lit("Hospital: Hospital "), "n_name", F.lit("\nEIN: 1\nState: "), "n_name", F.lit("\nReport Year: 2022\n== Identified Needs ==\n"))
    k = F.col("c_custkey")
    line = F.concat(F.lit("Need: "), "c_name", F.lit(" | Domain: "), "c_mktsegment", F.lit(" | Priority: "), F.when(k % 2 == 0, "Yes").otherwise("no"), F.lit(" | Rank: "), k % 9)
    r = extract.parse_rules(_composed(spark, sf, head, line), dataset("chna")).where("record_type = 'chna_need'")
    return r.select("hospital_name", "state", "report_year", "need", "domain", "is_priority", "priority_rank")


@query(f"SELECT n_name AS state, '2018-2020' AS report_period, c_name AS population_group, CAST(c_custkey AS INTEGER) AS pregnancy_related_deaths, c_custkey / 2.0e0 AS pregnancy_related_mortality_ratio, CASE WHEN c_custkey / 2.0e0 < 0 THEN 'fail' ELSE 'pass' END AS qa_status {CUST}")
def rule_parse_mmrc(spark, sf):
    head = F.concat(F.lit("State:  "), "n_name", F.lit("\nReport Period: 2018-2020\n== KEY FINDINGS ==\n"))
    k = F.col("c_custkey")
    line = F.concat(F.lit("Group: "), "c_name", F.lit(" | Pregnancy-Related Deaths: "), F.format_number(k, 0), F.lit(" | Ratio: "), (k / 2).cast("string"), F.lit(" per 100,000 | Preventable: 80%"))
    r = extract.parse_rules(_composed(spark, sf, head, line), dataset("mmrc")).where("record_type = 'mmrc_finding'")
    return r.select("state", "report_period", "population_group", "pregnancy_related_deaths", "pregnancy_related_mortality_ratio", "qa_status")


@query(f"SELECT n_name AS state, 'Demo' AS demonstration_name, c_name AS outcome_measure, CASE WHEN c_custkey % 3 = 0 THEN 'soared' ELSE 'Improved' END AS effect_direction, -c_custkey / 4.0e0 AS value, CASE WHEN c_custkey % 3 = 0 THEN 'warn' ELSE 'pass' END AS qa_status {CUST}")
def rule_parse_waiver_1115(spark, sf):
    head = F.concat(F.lit("State: "), "n_name", F.lit("\nDemonstration: Demo\nReport Year: x\nEvaluator: E\n== FINDINGS ==\n"))
    k = F.col("c_custkey")
    line = F.concat(F.lit("Outcome: "), "c_name", F.lit(" | Direction: "), F.when(k % 3 == 0, "soared").otherwise("Improved"), F.lit(" | Value: "), (-k / 4).cast("string"), F.lit(" | Unit: pp"))
    r = extract.parse_rules(_composed(spark, sf, head, line), dataset("waiver_1115")).where("record_type = 'waiver_1115_finding'")
    return r.select("state", "demonstration_name", "outcome_measure", "effect_direction", "value", "qa_status")


@query(f"SELECT 'Home ' || n_name AS facility_name, '05' || c_nationkey AS ccn, upper(n_name) AS state, 'F' || c_custkey AS ftag, CASE WHEN c_custkey % 4 = 0 THEN 'Z' ELSE 'D' END AS scope_severity, CASE WHEN c_custkey % 4 = 0 THEN 'warn' ELSE 'pass' END AS qa_status {CUST}")
def rule_parse_nursing_home(spark, sf):
    head = F.concat(F.lit("Facility: Home "), "n_name", F.lit("\nCCN: 05"), "n_nationkey", F.lit("\nState: "), F.lower("n_name"), F.lit("\nSurvey Date: May 3\n== DEFICIENCIES ==\n"))
    k = F.col("c_custkey")
    line = F.concat(F.lit("F-Tag: F"), k, F.lit(" | Description: d | Scope/Severity: "), F.when(k % 4 == 0, "z").otherwise(" d"), F.lit(" | Finding: f"))
    r = extract.parse_rules(_composed(spark, sf, head, line), dataset("nursing_home_2567")).where("record_type = 'nursing_home_deficiency'")
    return r.select("facility_name", "ccn", "state", "ftag", "scope_severity", "qa_status")


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    """Model answers, one a nation: JSON in prose, with a stray text among the items."""
    docs = _composed(spark, sf, F.lit(""), F.col("c_name"))
    k = lambda x: x["c_custkey"]
    items = F.transform(
        "ls",
        lambda x: F.to_json(
            F.struct(
                F.lit("P ").alias("plan_name"), x["l"].alias("measure_name"), F.lit("HEDIS").alias("measure_steward"), F.when(k(x) % 3 != 0, 2014 + k(x) % 12).alias("reporting_year"),
                (k(x) % 100).cast("string").alias("rate"), k(x).alias("numerator"), F.lit("5,000").alias("denominator"),
            )
        ),
    )
    answer = F.concat(F.lit('Here it is: {"state": " '), F.col("n_name"), F.lit('", "quality_measures": ["stray", '), F.array_join(items, ", "), F.lit("]} Done."))
    ids = text.request_id(F.col("document_id"), F.lit(0))
    return docs.select("*", answer.alias("answer"), ids.alias("custom_id"), F.lit(0).alias("chunk_index"))


@query(f"""SELECT upper(n_name) AS state, c_name AS measure_name, CAST(CASE WHEN c_custkey % 3 = 0 THEN 2024 ELSE 2014 + c_custkey % 12 END AS INTEGER) AS reporting_year, CAST(c_custkey % 100 AS DOUBLE) AS rate,
    CAST(c_custkey AS INTEGER) AS numerator, CAST(5000 AS INTEGER) AS denominator, CASE WHEN c_custkey > 5000 THEN 'fail' WHEN c_custkey % 3 = 0 OR c_custkey % 12 < 2 OR c_custkey % 12 = 11 THEN 'warn' ELSE 'pass' END AS qa_status {CUST}""")
def payload_records(spark, sf):
    a = _answers(spark, sf).withColumn("payload", extract.salvage_json(F.col("answer")))
    r = extract.payload_records(a, EQR)
    return r.select("state", "measure_name", "reporting_year", "rate", "numerator", "denominator", "qa_status")


@query("""WITH d AS (SELECT DISTINCT CAST(c_nationkey + 100 * (c_custkey // 50) AS BIGINT) AS ordinal, c_nationkey AS k FROM customer)
SELECT ordinal, CASE WHEN k % 4 = 0 THEN 'errored' ELSE 'unmapped' END AS reason FROM d WHERE k % 4 = 0 OR k % 7 = 1""")
def result_routing(spark, sf):
    a = _answers(spark, sf)
    k, other = F.col("ordinal") % 100, F.concat(F.lit("other-"), "ordinal")
    results = a.select(F.when((k % 7 == 1) & (k % 4 != 0), other).otherwise(F.col("custom_id")).alias("custom_id"), F.when(k % 4 == 0, "errored").otherwise("succeeded").alias("status"), "answer")
    _, lost = extract.route_results(results, a.select("custom_id", "document_id", "chunk_index"))
    own = a.select("ordinal", F.explode(F.array("custom_id", other)).alias("custom_id"))
    return lost.join(own, "custom_id").select("ordinal", "reason")


# The other kinds of records of each family.


@query(f"SELECT upper(n_name) AS state, 'Care' AS program, 'Plan ' || n_name AS plan_name, c_name AS pip_title, c_mktsegment AS clinical_focus_area, CAST(2023 AS INTEGER) AS reporting_year, (c_custkey % 90) / 2.0e0 AS baseline_rate, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 90 AS DOUBLE) END AS most_recent_rate, 'High' AS validation_status {CUST}")
def rule_parse_eqr_pip(spark, sf):
    head = F.concat(F.lit("State: "), "n_name", F.lit("\nReporting Year: 2023\nPlan: Plan "), "n_name", F.lit("\n== PERFORMANCE IMPROVEMENT PROJECTS ==\n"))
    k = F.col("c_custkey")
    recent = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit(" | Most Recent: "), k % 90, F.lit("%")))
    line = F.concat(F.lit("Title: "), "c_name", F.lit(" | Focus: "), "c_mktsegment", F.lit(" | Baseline: "), ((k % 90) / 2).cast("string"), F.lit("%"), recent, F.lit(" | Validation: High"))
    r = extract.parse_rules(_composed(spark, sf, head, line), EQR).where("record_type = 'eqr_pip'")
    return r.select("state", "program", "plan_name", "pip_title", "clinical_focus_area", "reporting_year", "baseline_rate", "most_recent_rate", "validation_status")


def _compliance(spark: SparkSession, sf: str) -> DataFrame:
    head = F.concat(F.lit("State: "), "n_name", F.lit("\nPlan: Plan "), "n_name", F.lit("\n== COMPLIANCE REVIEW ==\n"))
    line = F.concat(F.lit("Standard: "), "c_name", F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.concat(F.lit(" | Determination: "), "c_mktsegment")))
    return extract.parse_rules(_composed(spark, sf, head, line), EQR).where("record_type = 'eqr_compliance'")


@query(f"SELECT upper(n_name) AS state, 'Plan ' || n_name AS plan_name, c_name AS standard_area, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS determination {CUST}")
def rule_parse_eqr_compliance(spark, sf):
    return _compliance(spark, sf).select("state", "plan_name", "standard_area", F.nullif("determination", F.lit("")).alias("determination"))


@query(f"SELECT determination, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS determination {CUST}) GROUP BY determination")
def determination_mix(spark, sf):
    return analysis.determination_mix(_compliance(spark, sf))


@query(f"SELECT 'Hospital ' || n_name AS hospital_name, n_name AS state, CAST(2022 AS INTEGER) AS report_year, c_name AS need_addressed, 'do ' || c_custkey AS strategy, c_mktsegment AS measurable_objective {CUST}")
def rule_parse_chna_strategy(spark, sf):
    head = F.concat(F.lit("Hospital: Hospital "), "n_name", F.lit("\nState: "), "n_name", F.lit("\nReport Year: 2022\n== Implementation Strategies ==\n"))
    line = F.concat(F.lit("Need: "), "c_name", F.lit(" | Strategy: do "), "c_custkey", F.lit(" | Objective: "), "c_mktsegment")
    r = extract.parse_rules(_composed(spark, sf, head, line), dataset("chna")).where("record_type = 'chna_strategy'")
    return r.select("hospital_name", "state", "report_year", "need_addressed", "strategy", "measurable_objective")


@query(f"SELECT n_name AS state, CAST(2021 AS INTEGER) AS report_year, c_name AS recommendation, c_mktsegment AS category, 'system' AS target_level {CUST}")
def rule_parse_mmrc_recommendation(spark, sf):
    head = F.concat(F.lit("State: "), "n_name", F.lit("\nReport Year: 2021\n== RECOMMENDATIONS ==\n"))
    line = F.concat(F.lit("Recommendation: "), "c_name", F.lit(" | Category: "), "c_mktsegment", F.lit(" | Target: system"))
    r = extract.parse_rules(_composed(spark, sf, head, line), dataset("mmrc")).where("record_type = 'mmrc_recommendation'")
    return r.select("state", "report_year", "recommendation", "category", "target_level")


@query(f"SELECT n_name AS state, 'Demo' AS demonstration_name, CAST(2020 AS INTEGER) AS report_year, c_name AS recommendation, c_mktsegment AS category {CUST}")
def rule_parse_waiver_recommendation(spark, sf):
    head = F.concat(F.lit("State: "), "n_name", F.lit("\nDemonstration: Demo\nReport Year: 2020\n== RECOMMENDATIONS ==\n"))
    line = F.concat(F.lit("Recommendation: "), "c_name", F.lit(" | Category: "), "c_mktsegment")
    r = extract.parse_rules(_composed(spark, sf, head, line), dataset("waiver_1115")).where("record_type = 'waiver_1115_recommendation'")
    return r.select("state", "demonstration_name", "report_year", "recommendation", "category")


@query(f"SELECT 'Home ' || n_name AS facility_name, upper(n_name) AS state, 'F' || c_custkey AS ftag, 'fix ' || c_name AS correction, 'June ' || (c_custkey % 30) AS completion_date {CUST}")
def rule_parse_nursing_correction(spark, sf):
    head = F.concat(F.lit("Facility: Home "), "n_name", F.lit("\nState: "), F.lower("n_name"), F.lit("\n== PLANS OF CORRECTION ==\n"))
    line = F.concat(F.lit("Tag: F"), "c_custkey", F.lit(" | Correction: fix "), "c_name", F.lit(" | Completion: June "), F.col("c_custkey") % 30)
    r = extract.parse_rules(_composed(spark, sf, head, line), dataset("nursing_home_2567")).where("record_type = 'nursing_home_poc'")
    return r.select("facility_name", "state", "ftag", "correction", "completion_date")


# Payloads of the other families: two lists each, with a stray text among the items.


def _payload_records(spark: SparkSession, sf: str, name: str, scalars: str, **lists: Callable[[Column], list[Column]]) -> DataFrame:
    docs = _composed(spark, sf, F.lit(""), F.col("c_name"))
    items = lambda f: F.array_join(F.transform("ls", lambda x: F.to_json(F.struct(*f(x)))), ", ")
    parts = [F.concat(F.lit(f', "{n}": ["stray", '), items(f), F.lit("]")) for n, f in lists.items()]
    answer = F.concat(F.lit("{"), F.expr(scalars), *parts, F.lit("}"))
    return extract.payload_records(docs.select("*", extract.salvage_json(answer).alias("payload"), F.lit(0).alias("chunk_index")), dataset(name))


@query(f"""SELECT 'chna_need' AS record_type, 'H ' || n_name AS hospital_name, n_name AS state, CAST(2024 AS INTEGER) AS report_year, c_name AS what, CAST(c_custkey % 5 AS INTEGER) AS priority_rank, c_custkey % 2 = 0 AS is_priority {CUST}
    UNION ALL SELECT 'chna_strategy', 'H ' || n_name, n_name, 2024, 'do ' || c_name, NULL, NULL {CUST}""")
def payload_chna(spark, sf):
    k = lambda x: x["c_custkey"]
    r = _payload_records(
        spark, sf, "chna", """concat('"hospital_name": " H ', n_name, ' ", "state": "', n_name, '", "report_year": "<UNKNOWN>"')""",
        identified_needs=lambda x: [x["l"].alias("need"), (k(x) % 2 == 0).alias("is_priority"), (k(x) % 5).cast("string").alias("priority_rank")],
        implementation_strategies=lambda x: [F.concat(F.lit(" do "), x["l"]).alias("strategy")],
    )
    return r.select("record_type", "hospital_name", "state", "report_year", F.coalesce("need", "strategy").alias("what"), "priority_rank", "is_priority")


@query(f"""SELECT 'mmrc_finding' AS record_type, n_name AS state, c_name AS what, CAST(c_custkey AS INTEGER) AS deaths, c_custkey / 4.0e0 AS pct_preventable {CUST} UNION ALL SELECT 'mmrc_recommendation', n_name, 'do ' || c_name, NULL, NULL {CUST}""")
def payload_mmrc(spark, sf):
    k = lambda x: x["c_custkey"]
    r = _payload_records(
        spark, sf, "mmrc", """concat('"state": " ', n_name, ' ", "report_period": "2019", "report_year": 2021')""",
        findings=lambda x: [x["l"].alias("population_group"), k(x).alias("pregnancy_related_deaths"), (k(x) / 4).alias("pct_preventable")],
        recommendations=lambda x: [F.concat(F.lit("do "), x["l"]).alias("recommendation")],
    )
    return r.select("record_type", "state", F.coalesce("population_group", "recommendation").alias("what"), F.col("pregnancy_related_deaths").alias("deaths"), "pct_preventable")


@query(f"""SELECT 'waiver_1115_finding' AS record_type, n_name AS state, 'D ' || n_name AS demonstration_name, '11-W' AS waiver_id, 'Pub' AS evaluator, c_name AS what, -c_custkey / 8.0e0 AS value {CUST}
    UNION ALL SELECT 'waiver_1115_recommendation', n_name, 'D ' || n_name, NULL, NULL, 'do ' || c_name, NULL {CUST}""")
def payload_waiver_1115(spark, sf):
    r = _payload_records(
        spark, sf, "waiver_1115", """concat('"state": "', n_name, '", "demonstration_name": "D ', n_name, '", "waiver_id": "11-W"')""",
        findings=lambda x: [x["l"].alias("outcome_measure"), (-x["c_custkey"] / 8).alias("value")],
        recommendations=lambda x: [F.concat(F.lit("do "), x["l"]).alias("recommendation")],
    )
    return r.select("record_type", "state", "demonstration_name", "waiver_id", "evaluator", F.coalesce("outcome_measure", "recommendation").alias("what"), "value")


@query(f"""SELECT 'nursing_home_deficiency' AS record_type, 'N ' || n_name AS facility_name, upper(n_name) AS state, '0' || c_nationkey AS ccn, 'F' || c_custkey AS ftag, 'd' AS what {CUST}
    UNION ALL SELECT 'nursing_home_poc', 'N ' || n_name, upper(n_name), NULL, 'F' || c_custkey, 'fix ' || c_name {CUST}""")
def payload_nursing_home(spark, sf):
    tag = lambda x: F.concat(F.lit("F"), x["c_custkey"]).alias("ftag")
    r = _payload_records(
        spark, sf, "nursing_home_2567", """concat('"facility_name": "N ', n_name, '", "state": "', lower(n_name), '", "ccn": "0', ordinal % 100, '"')""",
        deficiencies=lambda x: [tag(x), F.lit("d").alias("deficiency_description")],
        plans_of_correction=lambda x: [tag(x), F.concat(F.lit("fix "), x["l"]).alias("correction")],
    )
    return r.select("record_type", "facility_name", "state", "ccn", "ftag", F.coalesce("deficiency_description", "correction").alias("what"))


# The axioms of the other families, run by the verifiers on parsed records.


def _checked(records: DataFrame, name: str, docs: DataFrame | None = None) -> DataFrame:
    out = pipeline.score(records, dataset(name), docs)
    return out.withColumn("symbolic", F.col("signals")[0]["score"])  # the first is the axioms'


@query(f"""SELECT c_name AS need, CASE WHEN n > 0 THEN 'warn' ELSE 'pass' END AS qa_status, pow(0.75e0, n) AS symbolic FROM (SELECT c_name, CAST(c_custkey % 9 = 0 AS INTEGER) + CAST(c_custkey % 2 = 1 AS INTEGER) AS n {CUST})""")
def axioms_chna(spark, sf):
    head, k = F.concat(F.lit("Hospital: Hospital "), "n_name", F.lit("\nReport Year: 2022\n== Identified Needs ==\n")), F.col("c_custkey")
    line = F.concat(F.lit("Need: "), "c_name", F.lit(" | Priority: "), F.when(k % 2 == 0, "Yes").otherwise("no"), F.lit(" | Rank: "), k % 9)
    return _checked(extract.parse_rules(_composed(spark, sf, head, line), dataset("chna")), "chna").select("need", "qa_status", "symbolic")


@query(f"""SELECT c_name AS population_group, CASE WHEN c_custkey % 120 > 100 THEN 'fail' ELSE 'pass' END AS qa_status, CASE WHEN c_custkey % 120 > 100 THEN 0.0e0 ELSE 1.0e0 END AS symbolic {CUST}""")
def axioms_mmrc(spark, sf):
    head, k = F.concat(F.lit("State: "), "n_name", F.lit("\nReport Period: 2019\n== FINDINGS ==\n")), F.col("c_custkey")
    line = F.concat(F.lit("Group: "), "c_name", F.lit(" | Preventable: "), k % 120)
    return _checked(extract.parse_rules(_composed(spark, sf, head, line), dataset("mmrc")), "mmrc").select("population_group", "qa_status", "symbolic")


@query(f"""SELECT c_name AS intervention, CASE WHEN n > 0 THEN 'warn' ELSE 'pass' END AS qa_status, pow(0.75e0, n) AS symbolic FROM (SELECT c_name, CAST(c_custkey % 3 = 0 AS INTEGER) + CAST(count(*) OVER (PARTITION BY n_name, g) > 1 AS INTEGER) AS n
    FROM (SELECT c_name, c_custkey, n_name, CASE WHEN c_custkey % 4 = 0 THEN 'same' ELSE c_name END AS g {CUST}))""")
def axioms_waiver_1115(spark, sf):
    head, k = F.concat(F.lit("State: "), "n_name", F.lit("\nDemonstration: Demo\nReport Year: 2020\n== FINDINGS ==\n")), F.col("c_custkey")
    name = F.when(k % 4 == 0, "same").otherwise(F.col("c_name"))
    line = F.concat(F.lit("Outcome: o | Intervention: "), name, F.lit(" | Direction: "), F.when(k % 3 == 0, "soared").otherwise("Improved"), F.lit(" | Result: "), "c_name")
    r = _checked(extract.parse_rules(_composed(spark, sf, head, line), dataset("waiver_1115")), "waiver_1115")
    return r.select(F.col("result").alias("intervention"), "qa_status", "symbolic")


@query(f"""SELECT 'F' || c_custkey AS ftag, CASE WHEN c_nationkey % 2 = 0 THEN 'fail' WHEN c_custkey % 4 = 0 THEN 'warn' ELSE 'pass' END AS qa_status, CASE WHEN c_custkey % 4 = 0 THEN 0.75e0 ELSE 1.0e0 END AS symbolic, c_nationkey % 2 = 0 AS capped {CUST}""")
def axioms_nursing_home(spark, sf):
    """With texts in which the cited spans of every other nation are missing: grounding fails these records."""
    head, k = F.concat(F.lit("Facility: Home "), "n_name", F.lit("\nState: x\n== DEFICIENCIES ==\n")), F.col("c_custkey")
    line = F.concat(F.lit("F-Tag: F"), k, F.lit(" | Scope/Severity: "), F.when(k % 4 == 0, "z").otherwise(" d"), F.lit(" | Finding: f"))
    docs = _composed(spark, sf, head, line)
    records = extract.parse_rules(docs, dataset("nursing_home_2567"))
    records = records.withColumn("provenance", F.col("provenance").withField("source_span", F.concat(F.lit("f-tag:  "), "ftag")))
    lost = docs.withColumn("text", F.when(F.col("ordinal") % 2 == 0, "another text").otherwise(F.col("text")))
    r = _checked(records, "nursing_home_2567", lost)
    return r.select("ftag", "qa_status", "symbolic", (F.col("trust_score") <= verify.FAIL_CEILING).alias("capped"))


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_salvage(spark, sf):
    v = extract.salvage_json(F.concat(F.lit("answer: "), "props", F.lit(" ok")))
    return table(spark, sf, "events").select("event_id", F.try_variant_get(v, "$.k", "int").alias("k"))


# ---------------------------------------------------------------- sources, merges, matches


@query("""SELECT page_id, CAST(i - 1 AS INTEGER) AS ordinal, h[i] AS href FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*?href="([^"]+)"[^>]*>', 1) AS h FROM pages), unnest(range(1, len(h) + 1)) t(i)""")
def page_anchors(spark, sf):
    return links.anchors(table(spark, sf, "pages")).select("page_id", "ordinal", "href")


@query(r"""WITH h AS (SELECT page_id, url AS base, regexp_extract_all(html, '<a [^>]*?href="([^"]+)"[^>]*>(.*?)</a>', 1) AS hrefs, regexp_extract_all(html, '<a [^>]*?href="([^"]+)"[^>]*>(.*?)</a>', 2) AS texts FROM pages),
l AS (SELECT page_id, i, regexp_extract(base, '^(https?://[^/?#]+)', 1) || hrefs[i] AS url, hrefs[i] AS href, trim(texts[i]) AS title FROM h, unnest(range(1, len(hrefs) + 1)) t(i)),
k AS (SELECT page_id, url, min(i) AS i, arg_min(title, i) AS title FROM l WHERE contains(lower(href || ' ' || title), 'th') OR contains(lower(href || ' ' || title), 'en') GROUP BY page_id, url),
r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) AS rank FROM k)
SELECT page_id, url, nullif(title, '') AS title, CAST(NULL AS INTEGER) AS year, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def report_links(spark, sf):
    found = links.anchors(table(spark, sf, "pages"))
    return links.report_links(found, ("th", "en"), require_document=False, most=3)


ORDERS_SPLIT = "SELECT o_orderkey, o_custkey, o_totalprice, 'old' AS wave FROM orders WHERE o_orderkey % 3 <> 0"


@query(f"""WITH new AS (SELECT o_orderkey, o_custkey, o_totalprice, 'new' AS wave FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 2 = 0), docs AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 3 = 0)
SELECT * FROM ({ORDERS_SPLIT}) o WHERE NOT EXISTS (SELECT 1 FROM docs d WHERE d.o_custkey = o.o_custkey) UNION ALL SELECT * FROM new""")
def merge_replace_by_id(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    fresh = o.where("o_orderkey % 3 = 0")
    old = o.where("o_orderkey % 3 <> 0").withColumn("wave", F.lit("old"))
    return merge.replace_by_id(old, fresh.where("o_custkey % 2 = 0").withColumn("wave", F.lit("new")), fresh, "o_custkey")


@query("SELECT 'eqr-v' || (s_suppkey // 10) || '.' || (s_suppkey % 10) || '.0.zip' AS name FROM supplier ORDER BY s_suppkey DESC LIMIT 1")
def latest_release(spark, sf):
    k = F.col("s_suppkey")
    name = F.concat(F.lit("eqr-v"), F.floor(k / 10), F.lit("."), k % 10, F.lit(".0.zip"))
    names = table(spark, sf, "supplier").select(name.alias("name"), k.alias("modified"))
    return merge.latest_release(names.unionByName(spark.createDataFrame([("notes.zip", 1 << 40)], "name string, modified long")))


@query("""SELECT url, min(page_id) AS page_id FROM pages p WHERE page_id % 5 <> 0 AND NOT EXISTS (SELECT 1 FROM pages q WHERE q.page_id % 3 = 0 AND q.url = p.url) GROUP BY url""")
def new_sources(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    c = p.withColumns({"verified": F.col("page_id") % 5 != 0, "year": F.lit("n/a")})
    return merge.new_sources(c, p.where("page_id % 3 = 0"), "page_id").select("url", "page_id")


@query("SELECT n_name AS state, string_agg(DISTINCT left(s_name, 80), ', ' ORDER BY left(s_name, 80)) AS names FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
def names_per_state(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return merge.names_by_state(s.withColumnRenamed("n_name", "state"), "state", "s_name")


@query(R2_SQL + f"""SELECT count(*) AS total, count(*) FILTER (b.nth IS NOT NULL) AS matched, count(*) FILTER (b.nth IS NOT NULL AND abs(b.rate - a.rate) <= greatest(0.1e0, 0.01e0 * abs(b.rate))) AS agree,
    count(*) FILTER (b.nth IS NOT NULL AND NOT abs(b.rate - a.rate) <= greatest(0.1e0, 0.01e0 * abs(b.rate))) AS disagree, count(*) FILTER (b.nth IS NULL) AS net_new FROM R a LEFT JOIN S b ON {KEY_EQ}""")
def vision_reconcile(spark, sf):
    r = measures(spark, sf)
    return reconcile.compare_summary(reconcile.compare_rates(second_reading(r), r, KEYS))


@query(R_SQL + """SELECT l_orderkey, l_linenumber, EXISTS (SELECT 1 FROM (SELECT DISTINCT state, reporting_year, rate FROM R WHERE l_orderkey % 5 = 0) t WHERE t.state = a.state AND t.reporting_year = a.reporting_year
    AND abs(a.rate + 0.05e0 - t.rate) <= greatest(0.15e0, 0.01e0 * abs(t.rate))) AS close FROM R a""")
def close_rate_exists(spark, sf):
    r = measures(spark, sf)
    moved = r.select("l_orderkey", "l_linenumber", "state", "reporting_year", (F.col("rate") + 0.05).alias("rate"))
    return reconcile.close_rate_exists(moved, r.where("l_orderkey % 5 = 0"), ["state", "reporting_year"]).select("l_orderkey", "l_linenumber", "close")


RECALL_SQL = """WITH a AS (SELECT DISTINCT p_size AS page, left(regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g'), 40) AS name FROM part),
b AS (SELECT DISTINCT p_size AS page, left(regexp_replace(lower(CASE WHEN p_partkey % 3 = 0 THEN 'x ' || reverse(p_name) ELSE p_name || ' rate' END), '[^a-z0-9]', '', 'g'), 40) AS name FROM part WHERE p_partkey % 4 <> 0),
f AS (SELECT page, name, EXISTS (SELECT 1 FROM b WHERE b.page = a.page AND (contains(a.name, b.name) OR contains(b.name, a.name) OR left(a.name, 10) = left(b.name, 10))) AS found FROM a)"""


def _recall(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").withColumn("page", F.col("p_size"))
    moved = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("x "), F.reverse("p_name"))).otherwise(F.concat("p_name", F.lit(" rate")))
    return reconcile.fuzzy_found(p, p.where("p_partkey % 4 <> 0").withColumn("p_name", moved), ["page"], "p_name")


@query(RECALL_SQL + " SELECT page, name, found FROM f")
def recall_fuzzy_match(spark, sf):
    return _recall(spark, sf)


@query(RECALL_SQL + """, g AS (SELECT page, count(*) AS n, count(*) FILTER (found) AS k FROM f GROUP BY page)
SELECT CAST(sum(n) AS BIGINT) AS n_reference, CAST(sum(k) AS BIGINT) AS n_found, round(sum(k) / CAST(sum(n) AS DOUBLE), 9) AS pooled_recall, round(avg(k / CAST(n AS DOUBLE)), 9) AS mean_page_recall FROM g""")
def pooled_recall(spark, sf):
    out = evaluate.pooled_recall(evaluate.page_recall(_recall(spark, sf), ["page"]))
    return out.withColumns({c: F.round(c, 9) for c in ("pooled_recall", "mean_page_recall")})


@query("""WITH f AS (SELECT p_size AS page, left(regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g'), 8) AS short, min(p_partkey) AS k FROM part GROUP BY ALL)
SELECT p_partkey, k AS matched_value FROM part LEFT JOIN f ON page = p_size AND short = left(regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g'), 8)""")
def first_prefix_match(spark, sf):
    p = table(spark, sf, "part").withColumns({"page": F.col("p_size"), "record_seq": F.col("p_partkey"), "value": F.col("p_partkey")})
    return reconcile.first_match(p, p, ["page"], "p_name").select("p_partkey", "matched_value")


@query(r"""WITH a AS (SELECT p_partkey, p_size AS page, p_brand, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS n FROM part),
b AS (SELECT DISTINCT p_size AS page, p_brand, p_name AS raw, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS n FROM part),
c AS (SELECT a.p_partkey, contains(a.n, b.n) OR contains(b.n, a.n) OR EXISTS (SELECT 1 FROM unnest(range(1, greatest(length(a.n) - 5, 1) + 1)) t(i) WHERE
    list_contains(list_transform(range(1, greatest(length(b.n) - 5, 1) + 1), lambda j: substr(b.n, j, 6)), substr(a.n, i, 6))) AS o FROM a JOIN b ON a.page = b.page AND a.p_brand = b.p_brand)
SELECT p_partkey, CASE WHEN bool_or(o) THEN count(*) FILTER (o) ELSE count(*) END AS n, count(*) FILTER (o) AS n_overlap FROM c GROUP BY p_partkey""")
def overlap_candidates(spark, sf):
    p = table(spark, sf, "part").withColumns({"page": F.col("p_size"), "record_seq": F.col("p_partkey")})
    got = reconcile.overlapping(p, p, ["page", "p_brand"], "p_name")
    return got.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n"), F.count_if("overlap").alias("n_overlap"))


# ---------------------------------------------------------------- release analysis


@query(R_SQL + "SELECT count(*) AS n_records, count(DISTINCT state) AS n_states, count(DISTINCT state || '|' || plan_name) AS n_state_plans, count(DISTINCT measure_name) AS n_measures FROM R")
def coverage_counts(spark, sf):
    return analysis.coverage(measures(spark, sf))


@query(R_SQL + "SELECT measure_name, count(*) AS n FROM R GROUP BY measure_name ORDER BY n DESC, min((l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate)) LIMIT 12")
def top_measures(spark, sf):
    return analysis.top_names(measures(spark, sf), "measure_name").select("measure_name", "n")


@query(R_SQL + """, K AS (SELECT unnest(['brand#1', 'BRAND#23', 'none']) AS keyword) SELECT keyword, state, count(*) AS n, round(avg(rate), 6) AS mean_rate FROM TR JOIN K ON contains(lower(measure_name), lower(keyword)) WHERE qa <> 'fail' GROUP BY keyword, state""")
def mean_rate_by_state(spark, sf):
    return analysis.mean_rate_by_state(scored(spark, sf), ["brand#1", "BRAND#23", "none"]).withColumn("mean_rate", F.round("mean_rate", 6))


@query(R_SQL + "SELECT qa AS qa_status, count(*) AS n, count(*) FILTER (qa = 'fail' OR trust < 0.85e0) AS n_review FROM TR GROUP BY qa")
def qa_mix(spark, sf):
    return analysis.qa_mix(scored(spark, sf))


@query(R_SQL + "SELECT state, count(*) FILTER (population = 'A') AS A, count(*) FILTER (population = 'N') AS N, count(*) FILTER (population = 'R') AS R, count(*) FILTER (population IN ('A', 'N', 'R')) AS total FROM R GROUP BY state")
def state_type_pivot(spark, sf):
    return analysis.state_by_type(measures(spark, sf), ["A", "N", "R"], "population")


@query(R_SQL + """, A AS (SELECT state, count(*) AS actual FROM R GROUP BY state), C AS (SELECT n_name AS state, CAST(n_nationkey * 100 AS BIGINT) AS claimed FROM nation)
SELECT coalesce(A.state, C.state) AS state, claimed, actual, coalesce(claimed = actual, false) AS holds FROM A FULL JOIN C ON A.state = C.state""")
def audit_checks(spark, sf):
    claims = table(spark, sf, "nation").select(F.col("n_name").alias("state"), (F.col("n_nationkey") * 100).cast("long").alias("claimed"))
    return analysis.check_claims(measures(spark, sf), claims, "state", "claimed")


@query(f"""SELECT upper(n_name) AS state, c_name AS need, CAST(NULL AS VARCHAR) AS prov_source_span, 1.0e0 AS prov_confidence, 'rule' AS prov_method, '' AS qa_flags, 1.0e0 AS trust_score {CUST}""".replace("upper(n_name)", "n_name"))
def curate_flatten(spark, sf):
    ds = dataset("chna")
    head = F.concat(F.lit("Hospital: H\nState: "), "n_name", F.lit("\n== IDENTIFIED NEEDS ==\n"))
    docs = _composed(spark, sf, head, F.concat(F.lit("Need: "), "c_name"))
    flat = curate.flatten(pipeline.run(docs, ds).records, "chna_need")
    return flat.select("state", "need", "prov_source_span", "prov_confidence", "prov_method", "qa_flags", "trust_score")


@query(f"SELECT 'chna_identified_needs' AS table, count(*) AS n {CUST}".replace("AS table", 'AS "table"'))
def rows_per_table(spark, sf):
    docs = _composed(spark, sf, F.lit("Hospital: H\n== IDENTIFIED NEEDS ==\n"), F.concat(F.lit("Need: "), "c_name"))
    return curate.table_counts(extract.parse_rules(docs, dataset("chna")))


@query(R2_SQL + f"""SELECT count(*) AS n_records, CAST((SELECT count(*) FROM S b WHERE NOT EXISTS (SELECT 1 FROM R a WHERE {KEY_EQ})) AS BIGINT) AS ensemble_omissions FROM R""")
def verified_with_second(spark, sf):
    r = measures(spark, sf)
    second = second_reading(r)
    out = verify.verify(r, EQR.axioms(), second=second, keys=KEYS, fields=EQR.ensemble_fields)
    lost = verify.omissions(r, second, KEYS).agg(F.count(F.lit(1)).alias("ensemble_omissions"))
    return out.agg(F.count("trust_score").alias("n_records")).crossJoin(lost)  # one row each


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark, sf):
    from attestor.streaming.ingest import windowed_counts

    return windowed_counts(table(spark, sf, "events"))


# ---------------------------------------------------------------- reviewer studies


@query("""WITH J AS (SELECT doc_id, quality = 1 AS x, toxic = 0 AS y, doc_id % 5 <> 0 AS a, doc_id % 7 <> 0 AS b FROM labels)
SELECT CAST(doc_id AS VARCHAR) AS row_uid, CAST(doc_id % 10 AS DOUBLE) AS score, CASE WHEN a AND b THEN x AND y WHEN a THEN x ELSE y END AS correct FROM J WHERE a OR b""")
def label_consensus(spark, sf):
    trust = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("row_uid"), (F.col("doc_id") % 10).cast("double").alias("score"))
    return evaluate.consensus(trust, *_reviewers(spark, sf))


@query(J_SQL + " SELECT count(DISTINCT score) AS distinct_scores, count(*) FILTER (score = (SELECT max(score) FROM J)) AS n_at_max, count(*) FILTER (score = (SELECT max(score) FROM J) AND NOT correct) AS errors_at_max FROM J")
def errors_at_best_score(spark, sf):
    return evaluate.at_best_score(judged(spark, sf))


@query(J_SQL + """, A AS (SELECT lang, count(*) AS n, count(*) FILTER (correct) AS k FROM J GROUP BY lang), B AS (SELECT *, k / CAST(n AS DOUBLE) AS p FROM A)
SELECT lang, n, k AS n_correct, round(p, 9) AS accuracy, round((p + 3.8416e0 / (2 * n)) / (1 + 3.8416e0 / n) - 1.96e0 * sqrt(p * (1 - p) / n + 3.8416e0 / (4.0e0 * n * n)) / (1 + 3.8416e0 / n), 9) AS low,
    round((p + 3.8416e0 / (2 * n)) / (1 + 3.8416e0 / n) + 1.96e0 * sqrt(p * (1 - p) / n + 3.8416e0 / (4.0e0 * n * n)) / (1 + 3.8416e0 / n), 9) AS high FROM B""")
def accuracy_by_bucket(spark, sf):
    out = evaluate.accuracy_by(judged(spark, sf), "lang")
    return out.withColumns({c: F.round(c, 9) for c in ("accuracy", "low", "high")})


@query("SELECT CAST(sum(turn) AS BIGINT) AS present, CAST(sum(turn % 3) AS BIGINT) AS missed, round(sum(turn) / CAST(sum(turn) + sum(turn % 3) AS DOUBLE), 9) AS recall FROM conversations")
def human_recall(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("turn").alias("present"), (F.col("turn") % 3).alias("missed"))
    return evaluate.human_recall(c).withColumn("recall", F.round("recall", 9))


@query("""WITH a AS (SELECT p_partkey, p_size, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS n FROM part),
b AS (SELECT p_partkey AS k, p_size AS s, regexp_replace(lower(left(p_name, 12)), '[^a-z0-9]', '', 'g') AS m, CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice END AS rate FROM part),
c AS (SELECT p_partkey, min((rate IS NULL, k, rate)) AS best FROM a JOIN b ON p_size = s AND (contains(n, m) OR contains(m, n)) GROUP BY p_partkey)
SELECT a.p_partkey, c.best IS NOT NULL AS matched, (SELECT rate FROM b WHERE b.k = c.best[2]) AS match_rate FROM a LEFT JOIN c USING (p_partkey)""")
def best_name_match(spark, sf):
    p = table(spark, sf, "part").withColumn("record_seq", F.col("p_partkey"))
    rate = F.when(F.col("p_partkey") % 3 != 0, F.col("p_retailprice"))
    other = p.withColumns({"rate": rate, "p_name": F.substring("p_name", 1, 12)})
    got = reconcile.best_match(p, other, ["p_size"], "p_name")
    return got.select("p_partkey", "matched", "match_rate")


@query("""WITH s AS (SELECT CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END AS truth, p_retailprice + p_partkey % 3 * 5 AS rate, p_retailprice + p_partkey % 2 * 20 AS baseline FROM part),
t AS (SELECT truth, coalesce(abs(rate - truth) <= greatest(0.2e0, 0.01e0 * abs(truth)), false) AS r, coalesce(abs(baseline - truth) <= greatest(0.2e0, 0.01e0 * abs(truth)), false) AS b FROM s)
SELECT count(*) AS n, count(*) FILTER (truth IS NOT NULL AND r AND NOT b) AS fixed, count(*) FILTER (truth IS NOT NULL AND b) AS baseline_right, count(*) FILTER (truth IS NOT NULL AND NOT r AND b) AS broken, count(*) FILTER (truth IS NULL) AS needs_human FROM t""")
def lift_summary(spark, sf):
    k, price = F.col("p_partkey"), F.col("p_retailprice")
    rows = table(spark, sf, "part").select(F.when(k % 4 != 0, price).alias("truth"), (price + k % 3 * 5).alias("rate"), (price + k % 2 * 20).alias("baseline"))
    return reconcile.lift_summary(rows)


@query("""SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'vector' ELSE 'ocr' END AS label_source, count(*) AS n, count(*) FILTER (v > 50) AS n_attributed
    FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderkey % 1000 WHEN 1 THEN (o_orderkey % 1000) / 10.0e0 END AS v FROM orders) WHERE v IS NOT NULL GROUP BY label_source""")
def figure_labels(spark, sf):
    k = F.col("o_orderkey")
    word = F.when(k % 3 == 0, F.concat(k % 1000, F.lit("%"))).when(k % 3 == 1, (k % 1000 / 10).cast("string")).otherwise(F.concat(k, F.lit(" of them")))
    labels = reconcile.number_labels(table(spark, sf, "orders").select(k, word.alias("word")))
    return reconcile.counts_by_source(labels.withColumns({"label_source": F.when(k % 2 == 0, "vector").otherwise("ocr"), "series": F.when(F.col("value") > 50, "a")}))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '{"b": 2}' ELSE '{"a": 1}' END AS answer, o_orderkey % 3 = 0 AS escalated FROM orders""")
def model_escalation(spark, sf):
    from attestor.operators import providers

    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(k.cast("string").alias("custom_id"), k)
    first = o.select("custom_id", F.when(k % 3 == 0, F.when(k % 2 == 0, "{}")).otherwise('{"a": 1}').alias("answer"))
    second = o.select("custom_id", F.lit('{"b": 2}').alias("answer"))
    return providers.escalate(first, second).select(F.col("custom_id").cast("long").alias("o_orderkey"), "answer", "escalated")


@query("SELECT DISTINCT sha256(text) AS document_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents e WHERE e.text = d.text AND e.doc_id % 3 = 0)")
def resume_pending(spark, sf):
    from attestor.operators import providers

    d = table(spark, sf, "documents").withColumn("document_id", F.sha2("text", 256))
    asked = text.requests(d, "doc_id")
    done = text.requests(d.where("doc_id % 3 = 0"), "doc_id").select("custom_id", F.lit("succeeded").alias("status"))
    return providers.pending(asked, done).select("document_id")


@query("""SELECT o_orderkey, status FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'errored' ELSE 'succeeded' END AS status FROM orders)""")
def provider_calls(spark, sf):
    from attestor.operators import providers

    def answer(chunk: str) -> str:
        if int(chunk) % 5 == 0:
            raise ValueError("no answer")
        return "{}"

    k = F.col("o_orderkey").cast("string")
    asked = table(spark, sf, "orders").select(k.alias("custom_id"), k.alias("chunk"))
    return providers.call_provider(asked, answer, retries=2, wait=0).select(F.col("custom_id").cast("long").alias("o_orderkey"), "status")


@query(RECALL_SQL + " SELECT page, name FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY name) AS nth FROM f WHERE NOT found) WHERE nth <= 5")
def recall_misses(spark, sf):
    return evaluate.misses(_recall(spark, sf), ["page"]).select("page", "name")


@query("SELECT conv_id, least(count(DISTINCT turn), 3) AS n FROM conversations GROUP BY conv_id")
def recall_pages(spark, sf):
    pages = table(spark, sf, "conversations").select("conv_id", "turn").distinct()
    return evaluate.pick_pages(pages, "conv_id", "turn").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Texas' WHEN 1 THEN 'District of Columbia' END AS name, CASE s_suppkey % 3 WHEN 0 THEN 'OH' WHEN 1 THEN 'WV' END AS code FROM supplier")
def state_names(spark, sf):
    from attestor.functions.states import state_code, state_name

    k = F.col("s_suppkey") % 3
    return table(spark, sf, "supplier").select("s_suppkey", state_name(F.when(k == 0, " tx").when(k == 1, "DC").otherwise("ZZ")).alias("name"), state_code(F.when(k == 0, "ohio").when(k == 1, "West Virginia ").otherwise("x")).alias("code"))


# ---------------------------------------------------------------- samples, answers, figure pages, stores

SAMPLE_SQL = """WITH g AS (SELECT coalesce(lang, '') AS stratum, count(*) AS size FROM documents GROUP BY ALL),
s AS (SELECT stratum, CAST(least(size, greatest(1, round_even(100.0e0 * size / (SELECT sum(size) FROM g), 0))) AS BIGINT) AS share FROM g),
d AS (SELECT doc_id, coalesce(lang, '') AS stratum, row_number() OVER (PARTITION BY lang ORDER BY sha1('sample:7:' || doc_id), doc_id) AS nth FROM documents),
c AS (SELECT doc_id, stratum FROM d JOIN s USING (stratum) WHERE nth <= share ORDER BY sha1('trim:7:' || doc_id), doc_id LIMIT 100)"""


def _sample(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.stratified_sample(table(spark, sf, "documents").select("doc_id", F.coalesce("lang", F.lit("")).alias("stratum")), 100, "stratum", "doc_id", 7)


@query(SAMPLE_SQL + " SELECT doc_id, stratum FROM c")
def sample_rows(spark, sf):
    return _sample(spark, sf)


@query(SAMPLE_SQL + " SELECT doc_id, row_number() OVER (ORDER BY sha1('double:7:' || doc_id), doc_id) <= 30 AS double_scored FROM c")
def sample_double_scored(spark, sf):
    return evaluate.double_scored(_sample(spark, sf), 30, "doc_id", 7).select("doc_id", "double_scored")


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 3 THEN 3 WHEN 5 THEN 1 ELSE 0 END AS n_items,
    CASE o_orderkey % 6 WHEN 0 THEN o_orderkey WHEN 1 THEN 2 * o_orderkey + 1 WHEN 3 THEN 3 WHEN 5 THEN 7 END AS total, o_orderkey % 6 IN (0, 1, 3, 5) AS is_object FROM orders""")
def answer_values(spark, sf):
    from attestor.operators import answers

    k = F.col("o_orderkey")
    s = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v.cast("string") for v in x])
    said = (
        F.when(k % 6 == 0, s('```json\n{"records": [{"k": ', k, ', "s": "a } ] \\" { b"}]}\n```\nSee {also} this.'))
        .when(k % 6 == 1, s('Here: [{"k": ', k, '}, {"k": ', k + 1, "}] and {more}"))
        .when(k % 6 == 2, s('{"records": [{"k": ', k, "}"))
        .when(k % 6 == 3, F.lit('{"records": [{"k": 1}, {"k": 2}, 3]}'))
        .when(k % 6 == 4, F.lit("no value, and a quote \" at the end of {"))
        .otherwise(F.lit('{"records": [{"k": 7}]} or {"records": []}'))
    )
    rows = table(spark, sf, "orders").select(k, said.alias("answer"))
    items = answers.listed(F.col("answer"))
    total = F.aggregate(F.transform(items, lambda v: F.try_variant_get(v, "$.k", "long")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0).cast("long")))
    return rows.select(k, F.size(items).alias("n_items"), F.when(F.size(items) > 0, total).alias("total"), answers.value(F.col("answer")).isNotNull().alias("is_object"))


FIGURES_SQL = """WITH f AS (SELECT p_partkey, p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey DESC) AS nth
    FROM part WHERE p_partkey % 3 = 0 AND (p_partkey % 2 = 1 OR p_size >= 12))"""


@query(FIGURES_SQL + """ SELECT 'd-' || p_brand AS document_id, CAST(p_partkey AS INTEGER) AS page_start, 'measure ' || p_partkey AS measure_name,
    CAST(CASE WHEN p_partkey % 4 = 0 THEN 50 ELSE p_size END AS DOUBLE) AS rate, 'vision' AS method FROM f WHERE nth <= 12 AND p_partkey % 5 <> 0""")
def vision_records(spark, sf):
    from attestor.operators import vision

    k, ds = F.col("p_partkey"), EQR
    pages = table(spark, sf, "part").select(
        F.concat(F.lit("d-"), "p_brand").alias("document_id"), k.cast("int").alias("page_no"), F.when(k % 3 == 0, "\n  Figure 2. Rates").otherwise("A figure of speech").alias("body"),
        (k % 2).alias("n_images"), F.col("p_size").alias("n_drawings"), F.col("p_name").cast("binary").alias("image"), k, "p_size",
    )
    asked = vision.page_requests(pages)
    told = asked.join(pages.select("document_id", "page_no", "p_size"), ["document_id", "page_no"])
    page = F.col("page_no")
    item = lambda rate: F.concat(F.lit('```json\n{"quality_measures": [{"plan_name": "P", "page": 9999, "reporting_year": 2024, "measure_name": "measure '), page, F.lit('", "rate": '), rate, F.lit("}]}\n```"))
    first = told.select("custom_id", F.when(page % 5 == 0, F.lit('{"quality_measures": []}')).when(page % 4 == 0, F.lit("nothing to read")).otherwise(item(F.col("p_size"))).alias("answer"))
    second = told.select("custom_id", F.when(page % 5 == 0, F.lit("{}")).otherwise(item(F.lit(50))).alias("answer"))
    null = F.lit(None).cast("string")
    docs = pages.select("document_id").distinct().select(
        "document_id", F.lit(0).cast("long").alias("ordinal"), null.alias("source_url"), F.lit("TX").alias("jurisdiction"), null.alias("program"), null.alias("publisher"), F.lit(2024).alias("report_year"), null.alias("text")
    )
    records = extract.extractor("vision")(vision.routed(vision.page_payloads(asked, first, ds, second), docs), ds)
    return records.select("provenance.source_document_id", "provenance.page_start", "measure_name", "rate", "provenance.method").withColumnRenamed("source_document_id", "document_id")


@query("""WITH p AS (SELECT url, min(page_id) AS page_id, min_by(html, page_id) AS html FROM pages WHERE url <> '' GROUP BY url)
SELECT url, page_id % 5 <> 0 AS ok, CASE WHEN page_id % 5 <> 0 THEN sha256(html) END AS document_id, CASE WHEN page_id % 5 = 0 THEN 'not recorded' END AS error, CAST(CASE WHEN page_id % 5 = 0 OR page_id % 5 = 1 THEN 2 ELSE 1 END AS INTEGER) AS tries FROM p""")
def fetch_cache(spark, sf):
    """Two runs over the same candidates: what the first one got is not asked for again."""
    from attestor.sources.fetch import FetchStore, by_record
    from attestor.sources.store import shared_folder

    pages = table(spark, sf, "pages").where("url <> ''").groupBy("url").agg(F.min("page_id").alias("page_id"), F.min_by("html", "page_id").alias("content"))
    store = FetchStore(spark, shared_folder(spark, "fetched"), 8)
    for known in (pages.where("page_id % 5 > 1"), pages.where("page_id % 5 > 0")):
        store.fetch(table(spark, sf, "pages"), lambda urls, known=known: by_record(urls, known))
    return store.fetched.select("url", "ok", "document_id", "error", "tries")


@query("""SELECT c_nationkey AS document_id, c_custkey, 'old' AS wave FROM customer WHERE c_nationkey % 3 <> 0 AND c_nationkey % 5 <> 0
UNION ALL SELECT c_nationkey, c_custkey, 'new' FROM customer WHERE c_nationkey % 3 = 0 AND c_custkey % 2 = 0""")
def release_merge(spark, sf):
    """A release in three batches: all documents, a third of them anew, a fifth without any row; the last one replayed."""
    from attestor.operators.release_table import ReleaseTable
    from attestor.sources.store import shared_folder

    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("document_id"), "c_custkey")
    docs = c.select("document_id").distinct()
    release = ReleaseTable(spark, shared_folder(spark, "release"), n_buckets=8)
    release.merge(c.withColumn("wave", F.lit("old")), docs, "a", 0)
    gone = docs.where("document_id % 5 = 0 and document_id % 3 <> 0")
    release.merge(c.where("false").withColumn("wave", F.lit("")), gone, "a", 3)
    wave = c.where("document_id % 3 = 0 and c_custkey % 2 = 0").withColumn("wave", F.lit("new"))
    for _ in range(2):
        release.merge(wave, docs.where("document_id % 3 = 0"), "a", 4)
    return release.read()


@query("""WITH n AS (SELECT count(*) AS n FROM orders) SELECT 'first' AS run, n AS request_count, CAST(ceil(n / 4000.0e0) AS INTEGER) AS n_batches, false AS resumed, n AS n_sent FROM n
UNION ALL SELECT 'again', n, CAST(ceil(n / 4000.0e0) AS INTEGER), true, 0 FROM n
UNION ALL SELECT 'changed', (SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 0), CAST(ceil((SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 0) / 4000.0e0) AS INTEGER), false, (SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 0) FROM n""")
def batch_run_state(spark, sf):
    """A run submitted, taken up again, and submitted anew for another number of requests."""
    from attestor.operators import batches
    from attestor.sources.store import shared_folder

    asked = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("custom_id"), F.col("o_orderstatus").alias("chunk"))
    folder, sent, seen = shared_folder(spark, "batches"), [], []

    def submit(some: DataFrame) -> dict[int, str]:
        got = some.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a batch
        sent.extend(r.n for r in got)
        return {r.block: f"b{r.block}" for r in got}

    for name, rows in (("first", asked), ("again", asked), ("changed", asked.where("o_orderkey % 3 <> 0"))):
        sent.clear()
        run = batches.start(rows, "orders", batches.Together(submit), folder, block=4000)
        seen.append((name, run.request_count, len(run.batch_ids), run.resumed, sum(sent)))
    return spark.createDataFrame(seen, "run string, request_count long, n_batches int, resumed boolean, n_sent long")


# ---------------------------------------------------------------- registries, files, outputs, streams


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    """Registry entries, one a supplier, of two reports each, of which the second leaves out what its entry says."""
    k, s = F.col("s_suppkey"), F.concat(F.lit("S"), F.col("s_nationkey"))
    named = lambda name: F.concat(F.lit(f"{name} "), k)
    null = F.lit(None).cast("string")
    report = lambda year, url, path, state, program: F.struct(
        year.cast("int").alias("year"), named("T").alias("title"), url.alias("url"), path.alias("local_path"), state.alias("state"), program.alias("program")
    )
    reports = F.array(
        report(2000 + k % 25, F.when(k % 3 == 0, named("http://u/")), F.concat(k, F.lit(".txt")), F.concat(F.lit("R"), k % 7), named("own")),
        report(1990 + k % 9, F.lit(""), F.when(k % 2 == 0, F.concat(k, F.lit("-b.txt"))), F.when(k % 5 == 0, "").otherwise(null), null),
    )
    return table(spark, sf, "supplier").select(
        k.cast("int").alias("ordinal"), s.alias("state"), named("prog").alias("program"), *[named(p).alias(p) for p in ("eqro", "hospital", "committee", "facility", "evaluator", "demonstration")],
        F.when(k % 4 == 0, named("http://l/")).alias("landing_url"), F.when(k % 8 == 0, 7).cast("int").alias("landing_max"), F.array(F.lit("a")).alias("landing_keywords"), reports.alias("reports"),
    )


FAMILIES = {"eqr": "eqro", "chna": "hospital", "mmrc": "committee", "waiver_1115": "evaluator", "nursing_home_2567": "facility"}
_PROGRAM = {"waiver_1115": "'demonstration ' || s_suppkey", "chna": "CAST(NULL AS VARCHAR)", "mmrc": "CAST(NULL AS VARCHAR)", "nursing_home_2567": "CAST(NULL AS VARCHAR)"}
DISCOVER_SQL = "WITH C AS (" + " UNION ALL ".join(
    f"""SELECT '{d}' AS dataset_id, s_suppkey AS k, 0 AS n, CASE WHEN s_suppkey % 3 = 0 THEN 'http://u/ ' || s_suppkey ELSE s_suppkey || '.txt' END AS location, 'R' || s_suppkey % 7 AS jurisdiction,
    {_PROGRAM.get(d, "'own ' || s_suppkey")} AS program, '{p} ' || s_suppkey AS publisher, CAST(2000 + s_suppkey % 25 AS INTEGER) AS report_year FROM supplier
UNION ALL SELECT '{d}', s_suppkey, 1, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey || '-b.txt' ELSE '<unknown>' END, 'S' || s_nationkey, {_PROGRAM.get(d, "'prog ' || s_suppkey")}, '{p} ' || s_suppkey, CAST(1990 + s_suppkey % 9 AS INTEGER) FROM supplier"""
    for d, p in FAMILIES.items()
) + ")"


@query(DISCOVER_SQL + " SELECT dataset_id, location, jurisdiction, program, publisher, report_year FROM C")
def discover_candidates(spark, sf):
    from attestor.sources import registry

    found = [registry.discover(_entries(spark, sf), d) for d in FAMILIES]
    return reduce(DataFrame.unionByName, found).select("dataset_id", "location", "jurisdiction", "program", "publisher", "report_year")


@query(DISCOVER_SQL + " SELECT location, report_year FROM C WHERE dataset_id = 'mmrc' ORDER BY k, n LIMIT 25")
def discover_limit(spark, sf):
    from attestor.sources import registry

    return registry.discover(_entries(spark, sf), "mmrc", 25).select("location", "report_year")


@query("SELECT s_suppkey AS ordinal, 'http://l/ ' || s_suppkey AS landing_url, CAST(CASE WHEN s_suppkey % 8 = 0 THEN 7 ELSE 3 END AS INTEGER) AS most FROM supplier WHERE s_suppkey % 4 = 0")
def landing_entries(spark, sf):
    from attestor.sources import registry

    return registry.landing_pages(_entries(spark, sf)).select(F.col("ordinal").cast("long").alias("ordinal"), "landing_url", "most")


@query("SELECT 'u' || doc_id AS url, sha256(text) AS document_id, text FROM documents WHERE doc_id % 4 <> 0 AND doc_id % 5 <> 0")
def text_cache_scan(spark, sf):
    from attestor.sources import documents
    from attestor.sources.store import shared_folder

    path, k = shared_folder(spark, "texts"), F.col("doc_id")
    rows = table(spark, sf, "documents").select(F.concat(F.lit("u"), k).alias("url"), (k % 4 != 0).alias("ok"), F.sha2("text", 256).alias("document_id"), F.when(k % 5 != 0, F.col("text")).otherwise("").alias("text"))
    rows.write.json(path)
    return documents.text_cache(spark, path)


@query("""WITH T AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'u' || o_orderkey END AS url, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey || '.txt' END AS path FROM orders)
SELECT k AS o_orderkey, CASE WHEN url IS NOT NULL AND k % 5 <> 0 THEN 'cached' WHEN path IS NOT NULL THEN 'local' END AS text, CASE WHEN url IS NOT NULL AND k % 5 <> 0 THEN 'c' || k WHEN path IS NOT NULL THEN 'l' || k END AS document_id FROM T""")
def texts_of_candidates(spark, sf):
    from attestor.sources import documents

    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(k)
    s = lambda *x: F.concat(*[v if isinstance(v, Column) and v is not k else v.cast("string") if v is k else F.lit(v) for v in x])
    candidates = o.select(k, F.when(k % 2 == 0, s("u", k)).alias("url"), F.when(k % 3 == 0, s(k, ".txt")).alias("local_path"), F.lit("x").alias("location"))
    cached = o.where("o_orderkey % 5 <> 0").select(s("u", k).alias("url"), s("c", k).alias("document_id"), F.lit("cached").alias("text"))
    local = o.select(s(k, ".txt").alias("local_path"), s("l", k).alias("document_id"), F.lit("local").alias("text"))
    return documents.attach_texts(candidates, cached, local).select(k, "text", "document_id")


@query("SELECT sha256(n_name || chr(10)) AS document_id, 'text/plain' AS mime, CAST(strlen(n_name) + 1 AS BIGINT) AS n_bytes, chr(10) || '[[PAGE 1]]' || chr(10) || n_name || chr(10) AS text FROM nation")
def local_files(spark, sf):
    from attestor.sources import documents
    from attestor.sources.store import shared_folder

    path = shared_folder(spark, "files")
    table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("value")).repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    files = documents.read_files(spark, path)
    new = documents.new_files(files, files.where("false"))
    return new.join(documents.plain_texts(files), "document_id").select("document_id", "mime", "n_bytes", "text")


@query("SELECT sha256(n_name || chr(10)) AS sha256, CAST(strlen(n_name) + 1 AS BIGINT) AS bytes, CAST(1 AS BIGINT) AS rows FROM nation")
def manifest_files(spark, sf):
    from attestor.sources.store import shared_folder

    path = shared_folder(spark, "manifest")
    table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("value")).repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    listed = json.loads(curate.manifest(spark, path, "d", "1", "CC0"))["files"]
    return spark.createDataFrame([(f["sha256"], f["bytes"], f["rows"]) for f in listed if f["name"].endswith(".txt")], "sha256 string, bytes long, rows long")


PUBLISHED_SQL = f"SELECT n_name AS state, c_name AS need, CAST(c_custkey % 9 AS VARCHAR) AS priority_rank, c_custkey {CUST}"


def _published(spark: SparkSession, sf: str) -> str:
    """A release of needs, written as tables, records and documents."""
    from attestor.sources.store import shared_folder

    head = F.concat(F.lit("Hospital: H\nState: "), "n_name", F.lit("\n== IDENTIFIED NEEDS ==\n"))
    docs = _composed(spark, sf, head, F.concat(F.lit("Need: "), "c_name", F.lit(" | Rank: "), F.col("c_custkey") % 9))
    path = shared_folder(spark, "published")
    pipeline.publish(pipeline.run(docs, dataset("chna")), dataset("chna"), path)
    return path


@query(f"WITH P AS ({PUBLISHED_SQL}) SELECT 'csv' AS kind, state, need, priority_rank FROM P UNION ALL SELECT 'parquet', state, need, priority_rank FROM P UNION ALL SELECT 'records', state, need, priority_rank FROM P")
def published_tables(spark, sf):
    from attestor.sources import releases

    path = _published(spark, sf)
    records, _ = releases.load_release(spark, path, dataset("chna"))
    csv = spark.read.option("header", True).csv(f"{path}/chna_identified_needs.csv")
    parquet = spark.read.parquet(f"{path}/chna_identified_needs.parquet")
    kinds = {"csv": csv, "parquet": parquet, "records": records}
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("kind"), "state", "need", F.col("priority_rank").cast("string").alias("priority_rank")) for k, df in kinds.items()])


@query(f"WITH P AS ({PUBLISHED_SQL}) SELECT count(DISTINCT (state, c_custkey // 50)) AS n_documents, count(*) AS n_predictions FROM P")
def published_documents(spark, sf):
    from attestor.sources import releases

    path = _published(spark, sf)
    _, documents = releases.load_release(spark, path, dataset("chna"))
    n = releases.load_predictions(spark, path, dataset("chna")).agg(F.countDistinct("record_seq").alias("n_predictions"))
    return documents.agg(F.countDistinct("document_id").alias("n_documents")).crossJoin(n)  # one row each


@query(f"WITH P AS ({PUBLISHED_SQL}) SELECT state, count(*) AS n, CAST(sum(CAST(priority_rank AS BIGINT)) AS BIGINT) AS ranks FROM P GROUP BY state")
def stream_ingest(spark, sf):
    """Documents that land as files, one of them twice, ingested in several micro-batches and merged into a release table."""
    from attestor.operators.release_table import ReleaseTable
    from attestor.sources.store import shared_folder
    from attestor.streaming import ingest

    head = F.concat(F.lit("Hospital: H\nState: "), "n_name", F.lit("\n== IDENTIFIED NEEDS ==\n"))
    docs = _composed(spark, sf, head, F.concat(F.lit("Need: "), "c_name", F.lit(" | Rank: "), F.col("c_custkey") % 9)).drop("ls", "n_name")
    root = shared_folder(spark, "stream")
    arrived = docs.withColumn("arrived", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("ordinal") % 60))
    arrived.unionByName(arrived.where("ordinal % 3 = 0")).repartition(4, "ordinal").write.json(f"{root}/in")
    stream = ingest.document_stream(spark, f"{root}/in", files_per_batch=2)
    ingest.ingest(stream, dataset("chna"), f"{root}/release", f"{root}/checkpoint", once=True, n_buckets=8).awaitTermination()
    rows = ReleaseTable(spark, f"{root}/release").read()
    return rows.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.sum("priority_rank").cast("long").alias("ranks"))


@query(_tau_sql("lang") + """, T AS (SELECT J.score >= threshold AS kept FROM J JOIN TAU ON J.lang = TAU.lang)
SELECT 0.3e0 AS alpha, 0.05e0 AS delta, count(*) AS n, count(*) FILTER (kept) AS auto_accepted, count(*) - count(*) FILTER (kept) AS sent_to_review, round(count(*) FILTER (kept) / CAST(count(*) AS DOUBLE), 4) AS coverage, true AS stratified FROM T""")
def gate_summary_stratified(spark, sf):
    j = judged(spark, sf)
    told = gate.annotate(j.withColumn("trust_score", F.col("score")), gate.thresholds(j, 0.3, 0.05), gate.thresholds(j, 0.3, 0.05, "lang"), "lang")
    return gate.calibrated_summary(told, 0.3, 0.05, True)


@query("""WITH P AS (SELECT url, min(page_id) AS k FROM pages p WHERE page_id % 5 <> 0 AND url <> '' AND NOT EXISTS (SELECT 1 FROM pages q WHERE q.page_id % 3 = 0 AND q.url = p.url) GROUP BY url),
F AS (SELECT unnest(['chna', 'nursing_home_2567', 'mmrc']) AS family)
SELECT family, k AS ordinal, CASE k % 3 WHEN 0 THEN 'OH' WHEN 1 THEN 'TX' ELSE 'Atlantis' END AS state, CASE WHEN family = 'chna' THEN 'Name ' || k END AS hospital, CASE WHEN family = 'nursing_home_2567' THEN 'Name ' || k END AS facility,
    CASE WHEN family = 'mmrc' THEN 'Name ' || k END AS title, url, CAST(CASE WHEN k % 2 = 0 THEN 2019 ELSE 2024 END AS INTEGER) AS year FROM P, F""")
def registry_entries(spark, sf):
    from attestor.sources import registry

    k = F.col("page_id")
    p = table(spark, sf, "pages").where("url <> ''").select("page_id", "url")
    c = p.withColumns({"verified": k % 5 != 0, "year": F.when(k % 2 == 0, "2019").otherwise("soon"), "state": F.when(k % 3 == 0, "ohio").when(k % 3 == 1, "TX").otherwise("Atlantis"), "name": F.concat(F.lit("Name "), k), "ordinal": k})
    fresh = merge.new_sources(c, p.where("page_id % 3 = 0"), "page_id")
    made = [registry.new_entries(fresh, d).select(F.lit(d).alias("family"), "*") for d in ("chna", "nursing_home_2567", "mmrc")]
    rows = reduce(DataFrame.unionByName, made).withColumn("_r", F.col("reports")[0])
    return rows.select("family", "ordinal", "state", "hospital", "facility", F.col("_r.title").alias("title"), F.col("_r.url").alias("url"), F.col("_r.year").alias("year"))


@query("""SELECT s AS state, string_agg(DISTINCT c_name, ',' ORDER BY c_name) AS names FROM (SELECT CASE c_nationkey % 3 WHEN 0 THEN 'Ohio' WHEN 1 THEN 'Texas' END AS s, c_name FROM customer WHERE c_custkey % 4 <> 0) WHERE s IS NOT NULL GROUP BY s""")
def published_names(spark, sf):
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    rows = table(spark, sf, "customer").select(F.when(n % 3 == 0, "oh").when(n % 3 == 1, " TX").otherwise("ZZ").alias("code"), F.when(k % 4 != 0, F.col("c_name")).otherwise("").alias("facility"))
    return merge.exclusions(rows.unionByName(rows), "code", "facility").select("state", F.array_join("names", ",").alias("names"))


@query("""SELECT CAST(doc_id AS VARCHAR) AS row_uid, quality = 1 AS correct FROM labels WHERE doc_id % 7 <> 0""")
def review_sheets(spark, sf):
    """Labels written as workbooks, one a reviewer, and read again; unreadable marks are left out."""
    from attestor.sources import sheets
    from attestor.sources.store import Folder, shared_folder

    k = F.col("doc_id")
    rows = table(spark, sf, "labels").select(k.cast("string").alias("row_uid"), F.when(k % 7 == 0, "maybe").when(F.col("quality") == 1, "yes").otherwise("0").alias("correct"), F.concat(F.lit("r"), k % 3).alias("reviewer"), k)
    folder = Folder(spark, shared_folder(spark, "sheets"))
    for r in sheets.sheet_files(rows, "reviewer", ["row_uid", "correct"], "doc_id").collect():  # a file a reviewer
        folder.put_bytes(f"{r.name}.xlsx", bytes(r.content))
    return evaluate.labels(sheets.labels(sheets.read_sheets(spark, folder.path, "Review")))
