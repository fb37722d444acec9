"""Golden values of single operators, and whole runs on texts of our own."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from attestor.functions import exprs as E
from attestor.functions import intervals as I
from attestor.operators import curate, evaluate, extract, gate, merge, reconcile, text, verify
from attestor.plans import pipeline
from attestor.plans.datasets import DATASETS, dataset
from attestor.sources import documents, links, registry, releases

EQR_TEXT = """Synthetic technical report
State: tx
Program: STAR
Reporting Year: 2024

== PERFORMANCE MEASURES ==
Plan: Lone Star Health
Measure: Well-Child: First 30 Months | Code: W30 | Steward: HEDIS | Rate: 58.2% | Numerator: 582 | Denominator: 1,000
Measure: Blood Pressure Control | Steward: NCQA | Rate: 70.0% | Numerator: 600 | Denominator: 1000
Measure: Breast Cancer Screening | Steward: Adult Core Set | Rate: 49.3% | Numerator: 2100 | Denominator: 2000
Measure: Asthma Ratio | Rate: 12.5 per 1,000 | Population: Adults
Measure: Asthma Ratio | Rate: 12.5 per 1,000 | Population: Adults
== PERFORMANCE IMPROVEMENT PROJECTS ==
Plan: Other Plan | Title: Dental Visits | Baseline: 40% | Goal: 50% | Most Recent: 44.5% | Validation: Met
== NOTES ==
Measure: Ignored | Rate: 1%
== COMPLIANCE REVIEW ==
Standard: Availability | Determination: Met
"""


def docs(spark, *texts, **more):
    base = {"jurisdiction": None, "program": None, "publisher": None, "report_year": 2024} | more
    rows = [(i, f"doc{i}", f"http://x/{i}", base["jurisdiction"], base["program"], base["publisher"], base["report_year"], t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "ordinal long, document_id string, source_url string, jurisdiction string, program string, publisher string, report_year int, text string")


def one(spark, column, **values):
    ddl = ", ".join(f"{k} {'double' if isinstance(v, float) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], ddl).select(column).first()[0]


@pytest.mark.parametrize("x,want", [("1,234", 1234), ("2.5", 2), ("3.5", 4), ("", None), (None, None), ("12d", None), ("nan", None), (" 7 ", 7), ("1e2", 100), ("99999999999", None)])
def test_to_int(spark, x, want):
    assert one(spark, E.to_int(F.col("x")), x=x) == want


@pytest.mark.parametrize("x,want", [(58.2, "58.2"), (100.0, "100"), (0.5, "0.5"), (1234567.0, "1.23457e+06"), (0.00001, "1e-05"), (-2.0, "-2"), (0.0, "0"), (123456.5, "123456"), (999999.5, "1e+06"), (0.0001234567, "0.000123457")])
def test_short_number(spark, x, want):
    assert one(spark, E.short_number(F.col("x")), x=x) == want == f"{x:g}"


def test_strip_and_lines(spark):
    assert one(spark, E.strip(F.col("x")), x="\t\x1c a b  \n") == "a b"
    parts = text.lines(spark.createDataFrame([("a\r\nb\x1cc  \nd",)], "text string")).orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in parts] == [(0, "a"), (1, "b"), (2, "c"), (4, "d")]


def test_bounded_logic(spark):
    t, u = I.known(1.0), I.interval(0.0, 1.0)
    got = spark.range(1).select(I.conjunction([t, u]), I.disjunction([u]), I.negate(u), I.implication(t, u), I.conjunction([]), I.contradicts(I.asserted(I.known(0.0)))).first()
    assert [tuple(x) if x not in (True, False) else x for x in got] == [(0, 1), (0, 1), (0, 1), (0, 1), (1, 1), True]


def test_rules_and_trust(spark):
    run = pipeline.run(docs(spark, EQR_TEXT), dataset("eqr"))
    rows = {r.measure_name: r for r in run.records.where("record_type = 'eqr_quality_measure'").collect()}
    r = rows["Well-Child: First 30 Months"]
    assert (r.state, r.program, r.plan_name, r.rate, r.numerator, r.denominator, r.measure_steward, r.trust_score, r.qa_status) == ("TX", "STAR", "Lone Star Health", 58.2, 582, 1000, "HEDIS", 1.0, "pass")
    bad = rows["Breast Cancer Screening"]
    assert [f.msg for f in bad.qa_flags] == ["numerator (2100) > denominator (2000)", "num_le_den: numerator 2100 exceeds denominator 2000", "rate_matches_ratio: printed rate 49.3 disagrees with implied 105.0"]
    assert (bad.trust_score, bad.qa_status, bad.review_recommended) == (0.0, "fail", True)
    soft = rows["Blood Pressure Control"]
    assert (soft.trust_score, soft.qa_status, soft.review_recommended) == (0.8255, "warn", True)
    assert rows["Asthma Ratio"].rate_unit == "per_1000" and "x2" in rows["Asthma Ratio"].qa_flags[0].msg
    counts = {r.table: r.n for r in curate.table_counts(run.records).collect()}
    assert counts == {"eqr_quality_measures": 5, "eqr_performance_improvement_projects": 1, "eqr_compliance_findings": 1}
    pip = run.records.where("record_type = 'eqr_pip'").first()
    assert (pip.plan_name, pip.baseline_rate, pip.most_recent_rate) == ("Other Plan", 40.0, 44.5)
    report = run.report.first()
    assert (report.n_records, report.qa_fail, report.qa_warn, report.review_recommended) == (7, 1, 3, 4)


def test_second_extraction_corroborates(spark):
    d, ds = docs(spark, EQR_TEXT), dataset("eqr")
    run = pipeline.run(d, ds, second=extract.parse_rules(d, ds))
    assert run.report.first().ensemble_omissions == 0
    trust = {r.measure_name: r.trust_score for r in run.records.where("measure_name is not null").collect()}
    assert trust["Blood Pressure Control"] == 0.88
    alone = pipeline.run(d, ds, second=extract.parse_rules(d, ds).where("measure_name like 'Asthma%'"))
    clean = alone.records.where("measure_name like 'Well%'").first()
    assert clean.trust_score == 0.8409 and clean.review_recommended


def test_ensemble_disagreement_and_omission(spark):
    ddl = "record_seq int, k string, rate double, n int, s string, flag boolean"
    a = spark.createDataFrame([(0, "a", 50.0, 10, "X", True), (1, None, 1.0, None, "y", None), (2, "gone", 1.0, 1, "z", True)], ddl)
    b = spark.createDataFrame([(0, "a", 1.0, 1, "q", True), (1, "a", 50.3, 10, " x ", False), (2, None, 1.0, None, "y", None), (3, "new", 1.0, 1, "z", True)], ddl)
    got = {r.k: r._ensemble for r in verify.reconcile(a, b, ["k"], ["rate", "n", "s", "flag"]).collect()}
    assert (got["a"].score, got["a"].ok, got["a"].detail) == (0.75, None, "models disagree on: flag (true vs false)")
    assert (got[None].score, got[None].ok) == (1.0, True) and got["gone"].score == 0.5
    assert [r.k for r in verify.omissions(a, b, ["k"]).collect()] == ["new"]


def test_grounding(spark):
    rows = [("rate of 58.2 percent", "The RATE of  58.2 percent.", 58.2, 1.0), ("rate of 58.2", "nothing", 58.2, 0.0), ("the rate", "the rate", 41.0, 0.1), ("", "x", 1.0, None), ("x", None, None, 1.0)]
    df = spark.createDataFrame(rows, "span string, text string, rate double, want double")
    got = df.select(verify.grounding(df.select("rate"), F.col("span"), F.col("text"))["score"].alias("s"), "want").collect()
    assert all(r.s == r.want for r in got)


def test_other_families(spark):
    t = "Hospital: Mercy\nEIN: 12-3\nState: CO\nReport Year: 2023\n== IDENTIFIED NEEDS ==\nNeed: Housing | Domain: Social | Priority: Yes | Rank: 1\nNeed: Dental | Rank: 2 | Priority: No\n== IMPLEMENTATION STRATEGIES ==\nNeed: Housing | Strategy: Build | Objective: 10 units\n"
    r = pipeline.run(docs(spark, t), dataset("chna")).records.orderBy("record_seq").collect()
    assert [(x.need, x.is_priority, x.priority_rank, x.trust_score) for x in r[:2]] == [("Housing", True, 1, 1.0), ("Dental", False, 2, 0.8255)]
    assert (r[2].strategy, r[2].need_addressed, r[2].hospital_name, r[2].report_year) == ("Build", "Housing", "Mercy", 2023)
    t = "State: GA\nReport Period: 2018-2020\n== FINDINGS ==\nGroup: Overall | Pregnancy-Related Deaths: 120 | Ratio: 30.2\nGroup: A | Pregnancy-Related Deaths: 90\nGroup: B | Pregnancy-Related Deaths: 130 | Preventable: 180%\n== RECOMMENDATIONS ==\nRecommendation: Do more | Target: Hospital\n"
    got = {x.population_group: x for x in pipeline.run(docs(spark, t), dataset("mmrc")).records.where("record_type = 'mmrc_finding'").collect()}
    assert [f.msg for f in got["Overall"].qa_flags] == ["subgroup_le_overall: sum of subgroup deaths exceeds overall"]
    assert got["A"].qa_status == "pass" and got["B"].qa_status == "fail" and any("exceed overall 120" in f.msg for f in got["B"].qa_flags)
    t = "Facility: Oak\nCCN: 0501\nState: ca\n== DEFICIENCIES ==\nF-Tag: F600 | Scope/Severity: d | Finding: f\nF-Tag: F600 | Scope/Severity: q\n== PLANS OF CORRECTION ==\nTag: F600 | Correction: Train | Completion: May\n"
    got = pipeline.run(docs(spark, t), dataset("nursing_home_2567")).records.orderBy("record_seq").collect()
    assert [(x.state, x.scope_severity, x.qa_status) for x in got] == [("CA", "D", "warn"), ("CA", "Q", "warn"), ("CA", None, "pass")]
    t = "State: NY\nDemonstration: D\nReport Year: 1900\n== FINDINGS ==\nOutcome: o | Direction: Improved | Value: -2.5 | Result: r\n== RECOMMENDATIONS ==\nRecommendation: go\n"
    got = pipeline.run(docs(spark, t), dataset("waiver_1115")).records.orderBy("record_seq").collect()
    assert (got[0].value, got[0].qa_status, got[1].recommendation) == (-2.5, "fail", "go")
    with pytest.raises(KeyError, match="known: chna"):
        dataset("nope")


def test_payloads_survive_junk(spark):
    body = {"state": "tx", "quality_measures": ["junk", {"plan_name": " P ", "measure_name": "M", "rate": 58.2, "rate_unit": "RATIO", "reporting_year": "<UNKNOWN>", "numerator": "1,000"}, {"plan_name": None, "measure_name": "N", "rate": "7 per 1,000", "reporting_year": 2026, "page": 3}, {"plan_name": "P", "measure_name": "O", "reporting_year": 2010}]}
    p = docs(spark, "").withColumns({"chunk_index": F.lit(0), "payload": F.parse_json(F.lit(json.dumps(body)))})
    ds = dataset("eqr")
    good, bad = extract.quarantine(extract.payload_records(p, ds), ds)
    got = {r.measure_name: r for r in good.collect()}
    assert (got["M"].plan_name, got["M"].rate, got["M"].rate_unit, got["M"].numerator, got["M"].reporting_year, got["M"].state) == ("P", 58.2, "ratio", 1000, 2024, "TX")
    assert "defaulted to publication year 2024" in got["M"].qa_flags[0].msg and "implausibly far" in got["O"].qa_flags[0].msg
    lost = bad.first()
    assert (lost.measure_name, lost.error, lost.rate_unit, lost.provenance.page_start) == ("N", "missing required: plan_name", "per_1000", 3)
    nothing = docs(spark, "").withColumns({"chunk_index": F.lit(0), "payload": F.parse_json(F.lit("{}"))})
    for name in DATASETS:
        assert extract.payload_records(nothing, dataset(name)).count() == 0


def test_salvage_and_routing(spark):
    rows = [("a", "succeeded", 'Sure: {"x": 1} ok'), ("b", "errored", None), ("c", "succeeded", "{}"), ("a2", "succeeded", "no json")]
    results = spark.createDataFrame(rows, "custom_id string, status string, answer string")
    wanted = spark.createDataFrame([("a", "d1", 0), ("b", "d1", 1), ("a2", "d2", 0)], "custom_id string, document_id string, chunk_index int")
    ok, lost = extract.route_results(results, wanted)
    assert [r.custom_id for r in ok.collect()] == ["a"]
    assert {r.custom_id: r.reason for r in lost.collect()} == {"b": "errored", "c": "unmapped"}


def test_chunks_keep_the_text(spark):
    pages = spark.createDataFrame([("d", i, "x" * n) for i, n in enumerate((10, 50, 5, 5, 200, 1))], "document_id string, n int, body string")
    marked = text.marked_texts(pages, "document_id", "n", "body")
    r = marked.select("text", text.chunks(F.col("text"), 80).alias("c"), text.page_count(F.col("text")).alias("n")).first()
    assert "".join(r.c) == r.text and r.n == 6 and all(len(c) <= 80 or c.count("[[PAGE ") == 1 for c in r.c)
    assert text.requests(marked.withColumn("ordinal", F.lit(1)).union(marked.withColumn("ordinal", F.lit(0))), "ordinal", 80).count() == len(r.c)


def test_gate(spark):
    pairs = [(0.9, True, "a")] * 40 + [(0.3, False, "b")] * 20
    df = spark.createDataFrame(pairs, "score double, correct boolean, g string")
    overall, by = gate.thresholds(df, 0.2, 0.1), gate.thresholds(df, 0.2, 0.1, "g")
    assert overall.first().threshold == 0.9 and {r.g: r.threshold for r in by.collect()} == {"a": 0.9, "b": None}
    asked = spark.createDataFrame([(0.95, "a"), (0.95, "b"), (0.95, "new"), (0.1, "a"), (None, "a")], "trust_score double, g string")
    got = gate.annotate(asked, overall, by, "g")
    assert [r.review_recommended for r in got.collect()] == [False, True, False, True, True]
    assert gate.summary(got).first().coverage == 0.4


def test_agreement_and_accuracy(spark):
    sheet = lambda xs: evaluate.labels(spark.createDataFrame([(f"u{i}", x, i) for i, x in enumerate(xs)] + [("u0", xs[0], 99), ("", "1", 100), ("u9", "maybe", 101)], "row_uid string, correct string, record_seq int"))
    a, b = sheet(["1", "yes", "0", "no"]), sheet(["1", "0", "0", "N"])
    r = evaluate.agreement(a, b).first()
    assert (r.n_overlap, r.percent_agreement, r.cohen_kappa, r.gwet_ac1, r.a_correct_b_incorrect) == (4, 0.75, 0.5, 0.5294, 1)
    assert [x.row_uid for x in evaluate.disagreements(a, b).collect()] == ["u1"]
    none = evaluate.agreement(a.where("false"), b).first()
    assert none.n_overlap == 0 and none.cohen_kappa is None
    same = evaluate.agreement(a.where("correct"), a.where("correct")).first()
    assert same.cohen_kappa == 1.0
    low, high = E.wilson(F.lit(12), F.lit(13))
    assert [round(x, 4) for x in spark.range(1).select(low, high).first()] == [0.6669, 0.9863]


def test_merge_replaces_documents(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "document_id string, v int")
    new = spark.createDataFrame([("b", 9)], "document_id string, v int")
    again = spark.createDataFrame([("b",), ("c",)], "document_id string")
    assert sorted(map(tuple, merge.replace_by_id(old, new, again).collect())) == [("a", 1), ("b", 9)]
    names = spark.createDataFrame([("eqr-v0.10.0.zip", 1), ("eqr-v0.9.9.zip", 5), ("notes.zip", 9)], "name string, modified int")
    assert merge.latest_release(names).first().name == "eqr-v0.10.0.zip"


def test_release_round_trip_and_waves(spark, tmp_path):
    ds = dataset("eqr")
    first = pipeline.run(docs(spark, EQR_TEXT), ds)
    got = pipeline.publish(first, ds, f"{tmp_path}/r")
    assert got["tables"]["eqr_quality_measures"] == 5 and got["summary"]["n_records"] == 7
    records, old_docs = releases.load_release(spark, f"{tmp_path}/r", ds)
    assert records.count() == 7 and records.where("trust_score = 0").count() == 1
    wave = pipeline.run(docs(spark, EQR_TEXT.replace("Measure: Breast", "Dropped: Breast")), ds)
    merged = pipeline.merge_wave(records, old_docs.withColumn("report_year", F.col("report_year").cast("int")).withColumn("n_pages", F.col("n_pages").cast("int")), wave)
    assert merged.records.count() == 6 and merged.documents.count() == 1 and merged.report.first().qa_fail == 0
    listed = json.loads(curate.manifest(spark, f"{tmp_path}/r", "eqr", "0.1.0", "CC-BY-4.0"))["files"]
    assert all(len(f["sha256"]) == 64 and f["bytes"] > 0 for f in listed)
    rows_of = lambda part: sum(f["rows"] or 0 for f in listed if part in f["name"])
    assert rows_of("records.jsonl") == spark.read.text(f"{tmp_path}/r/records.jsonl").count() > 0 and rows_of("documents.csv") == spark.read.csv(f"{tmp_path}/r/documents.csv", header=True).count() > 0
    assert rows_of("eqr_quality_measures.parquet") == spark.read.parquet(f"{tmp_path}/r/eqr_quality_measures.parquet").count()
    with pytest.raises(ValueError, match="unknown extractor"):
        extract.extractor("magic")
    assert "eqr_quality_measures" in curate.data_dictionary(ds) and "RecordSet" in curate.croissant(ds, got["tables"], "http://x", "CC-BY-4.0")
    with pytest.raises(releases.InvalidRelease, match="unknown record types"):
        releases.load_release(spark, f"{tmp_path}/r", dataset("chna"))
    with pytest.raises(releases.InvalidRelease):
        releases.load_release(spark, f"{tmp_path}/absent", ds)
    preds = releases.load_predictions(spark, f"{tmp_path}/r", ds)
    sheet = evaluate.gold_sheet(preds, list(ds.identity), list(ds.ensemble_fields))
    gold = sheet.withColumn("correct", F.when(F.col("measure_name").like("Breast%"), "0").otherwise("1"))
    parts = evaluate.evaluate(gold, preds, by="state")
    assert parts["accuracy"].first().overall_accuracy == 0.8 and parts["risk_coverage"].count() == 5
    assert evaluate.stratified_sample(preds, 3, "state", "row_uid").count() <= 3


def test_links(spark):
    html = '<a href="/r/2023.pdf">EQR report</a><a href="https://y/a.pdf">Technical <b>Report 2024</b></a><a href="/r/2023.pdf">EQR again</a><a href="x.html">report</a><a name=q>none</a><a href="z.pdf">minutes</a><a href="u.pdf">report'
    pages = spark.createDataFrame([(1, "https://s.gov/p/", html), (2, "", None)], "page_id long, url string, html string")
    got = links.report_links(links.anchors(pages), ["report"]).orderBy("rank").collect()
    assert [(r.url, r.year, r.title) for r in got] == [("https://y/a.pdf", 2024, "Technical Report 2024"), ("https://s.gov/r/2023.pdf", 2023, "EQR report")]
    assert links.report_links(links.anchors(pages), ["report"], most=1).count() == 1


def test_anchors(spark):
    html = """<!-- <a href="/hidden">no</a> --><script>var x = '<a href="/code">no</a>';</script>
    <A class='k' HREF='/one?a=1&amp;b=2'>One &amp; <i>only</i></A> <a href=bare.html>bare</a> <a data-href="/no">no</a> <a href="">empty</a>
    <a href="/outer">outer <a name="n">still</a> <a href="/x>y">cut <a href="/inner">\n inner </a> <a title="a > b" href="/q">q</a > <a href="/open">open"""
    pages = spark.createDataFrame([(1, "https://s.gov/p/q.html", html), (2, "https://s.gov", '<a href="r.pdf">r</a><a href="http://[bad">b</a>'), (3, "u", ""), (4, "u", None)], "page_id long, url string, html string")
    got = [(r.page_id, r.ordinal, r.href, r.text, r.link) for r in links.anchors(pages).orderBy("page_id", "ordinal").collect()]
    assert got == [
        (1, 0, "/one?a=1&b=2", "One & only", "https://s.gov/one?a=1&b=2"), (1, 1, "bare.html", "bare", "https://s.gov/p/bare.html"), (1, 2, "/outer", "outer still", "https://s.gov/outer"),
        (1, 3, "/inner", "inner", "https://s.gov/inner"), (1, 4, "/q", "q", "https://s.gov/q"), (2, 0, "r.pdf", "r", "https://s.gov/r.pdf"), (2, 1, "http://[bad", "b", None),
    ]
    assert links.anchors(pages.where("false")).count() == 0
    landing = """<ul><li><a href="/papers/review-2031.pdf">2031 quality review</a></li><li><a href="old/review_2030.pdf">Quality review (2030)</a></li>
    <li><a href="https://elsewhere.example/plan-2031.pdf">Spending plan 2031</a></li><li><a href="/team.html">The team</a></li></ul>"""
    page = spark.createDataFrame([(1, "https://health.example/mc/", landing)], "page_id long, url string, html string")
    ask = lambda **more: [(r.url, r.year) for r in links.report_links(links.anchors(page), ["quality", "review"], **more).orderBy("rank").collect()]
    assert ask() == [("https://health.example/papers/review-2031.pdf", 2031), ("https://health.example/mc/old/review_2030.pdf", 2030)]
    assert ask(most=1) == [("https://health.example/papers/review-2031.pdf", 2031)]


def test_landing_pages(spark):
    entries = spark.createDataFrame([(0, "http://a/", None, None), (1, "http://a/", ["minutes"], 5), (2, None, None, None), (3, "http://gone/", None, None)], "ordinal int, landing_url string, landing_keywords array<string>, landing_max int")
    html = "".join(f'<a href="/r{y}.pdf">EQR report {y}</a>' for y in range(2015, 2020)) + '<a href="/m.pdf">Minutes</a>'
    pages = spark.createDataFrame([("http://a/", html)], "url string, html string")
    got = links.landing_candidates(entries, pages, ["eqr"]).orderBy("entry", "rank").collect()
    assert [(r.entry, r.url) for r in got] == [(0, "http://a/r2019.pdf"), (0, "http://a/r2018.pdf"), (0, "http://a/r2017.pdf"), (1, "http://a/m.pdf")]


def test_providers(spark):
    from attestor.operators import providers

    def answer(chunk):
        if chunk == "bad":
            raise RuntimeError("down")
        return chunk.upper()

    asked = spark.createDataFrame([("a", "x"), ("b", "bad")], "custom_id string, chunk string")
    got = providers.call_provider(asked, answer, tasks=2, retries=2, wait=0)
    assert {r.custom_id: (r.status, r.answer, r.error) for r in got.collect()} == {"a": ("succeeded", "X", None), "b": ("errored", None, "RuntimeError: down")}
    assert [r.custom_id for r in providers.pending(asked, got).collect()] == ["b"]
    recorded = spark.createDataFrame([("a", "{}")], "custom_id string, answer string")
    assert {r.custom_id: r.status for r in providers.answers_from(asked, recorded).collect()} == {"a": "succeeded", "b": "missing"}
    assert providers.blocks(asked, 1).where("block between 0 and 1").count() == 2


def test_command_line(spark, tmp_path, capsys):
    from attestor.plans import cli

    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.txt").write_text(EQR_TEXT)
    (tmp_path / "sources_eqr.yaml").write_text("sources:\n- {state: TX, eqro: Q, reports: [{year: 2024, local_path: data/a.txt}]}\n")
    source = ["--dataset", "eqr", "--registry", str(tmp_path), "--files", str(tmp_path / "f"), "--no-parquet"]
    cli.main(["run", *source, "--out", f"{tmp_path}/r"])
    assert json.loads(capsys.readouterr().out)["tables"]["eqr_quality_measures"] == 5
    cli.main(["batch", *source, "--merge", f"{tmp_path}/r", "--out", f"{tmp_path}/r2"])
    assert json.loads(capsys.readouterr().out)["summary"]["n_records"] == 7
    cli.main(["sample", "--dataset", "eqr", "--release", f"{tmp_path}/r2", "--n", "3", "--out", f"{tmp_path}/gold"])
    assert json.loads(capsys.readouterr().out)["sampled"] == 3
    sheet = spark.read.option("header", True).csv(f"{tmp_path}/gold").withColumn("correct", F.lit("1"))
    sheet.write.option("header", True).csv(f"{tmp_path}/labels")
    cli.main(["evaluate", "--dataset", "eqr", "--release", f"{tmp_path}/r2", "--gold", f"{tmp_path}/labels"])
    assert json.loads(capsys.readouterr().out)["overall_accuracy"] == 1.0
    cli.main(["agreement", "--a", f"{tmp_path}/labels", "--b", f"{tmp_path}/labels"])
    assert json.loads(capsys.readouterr().out)["cohen_kappa"] == 1.0


def test_agreement_command_gives_every_disagreement(spark, tmp_path, capsys):
    from attestor.plans import cli

    for name, correct in (("a", "1"), ("b", "0")):
        rows = spark.range(1500).select(F.format_string("u%05d", "id").alias("row_uid"), F.lit(correct).alias("correct"))
        rows.write.option("header", True).csv(f"{tmp_path}/{name}")
    want = [f"u{i:05d}" for i in range(1500)]
    sheets = ["agreement", "--a", f"{tmp_path}/a", "--b", f"{tmp_path}/b"]
    cli.main(sheets)
    got = json.loads(capsys.readouterr().out)
    assert got["n_disagreements"] == 1500 and got["disagreement_row_uids"] == want
    cli.main([*sheets, "--out", f"{tmp_path}/d"])
    got = json.loads(capsys.readouterr().out)
    assert got["n_disagreements"] == 1500 and got["disagreement_examples"] == want[: cli.EXAMPLES]
    assert sorted(r.row_uid for r in spark.read.option("header", True).csv(got["disagreements"]).collect()) == want


def test_registry_and_documents(spark, tmp_path):
    (tmp_path / "sources_eqr_a.yaml").write_text("sources:\n- {state: TX, program: P, eqro: Q, reports: [{year: 2024, local_path: a.txt}, {year: 2023, url: 'http://u', state: ''}]}\n")
    (tmp_path / "sources_eqr_b.yaml").write_text("sources:\n- {state: OH, landing_url: 'http://l', reports: []}\n")
    entries = registry.load_sources(spark, "eqr", str(tmp_path))
    got = registry.discover(entries, "eqr").orderBy("candidate_seq").collect()
    assert [(r.jurisdiction, r.publisher, r.report_year, r.location) for r in got] == [("TX", "Q", 2024, "a.txt"), ("TX", "Q", 2023, "http://u")]
    assert registry.discover(entries, "eqr", 1).count() == 1 and registry.landing_pages(entries).first().most == 3
    (tmp_path / "catalog.yaml").write_text("datasets:\n- {id: eqr, name: N, existing_efforts: [{name: a, what: b}]}\n")
    catalog = registry.load_catalog(spark, str(tmp_path / "catalog.yaml"))
    assert registry.dataset_meta(catalog, "eqr").first().name == "N" and registry.dataset_meta(catalog, "zzz").first().name == "zzz"
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.txt").write_text(" body \n")
    (tmp_path / "f" / "b.txt").write_text(" body \n")
    files = documents.read_files(spark, str(tmp_path / "f"))
    assert documents.new_files(files, files.where("false")).count() == 1
    assert documents.plain_texts(files).first().text == "\n[[PAGE 1]]\nbody\n"
    pages = documents.page_texts(files, lambda b: [b.decode(), " two "]).collect()
    assert sorted({(r.page_no, r.body) for r in pages}) == [(1, "body"), (2, "two")]
    assert "ZeroDivisionError" in documents.page_texts(files, lambda b: 1 // 0).first().error
    (tmp_path / "cache.jsonl").write_text('{"url":"http://u","ok":true,"document_id":"d","text":"t"}\n{"url":"http://u","ok":true,"document_id":"d2","text":"t2"}\n{"url":"v","ok":false,"text":"x"}\n')
    cached = documents.text_cache(spark, str(tmp_path / "cache.jsonl"))
    assert [tuple(r) for r in cached.collect()] == [("http://u", "d2", "t2")]
    local = files.select(F.lit("a.txt").alias("local_path"), "document_id", F.lit("local").alias("text")).limit(1)
    joined = documents.attach_texts(registry.discover(entries, "eqr"), cached, local).orderBy("candidate_seq").collect()
    assert [r.text for r in joined] == ["local", "t2"]


def test_stream_ingests_and_merges(spark, tmp_path):
    from attestor.operators.release_table import ReleaseTable
    from attestor.streaming import ingest

    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    doc = {"ordinal": 0, "document_id": "d0", "source_url": "u", "report_year": 2024, "text": EQR_TEXT, "arrived": "2026-01-01T00:00:00Z"}
    (src / "1.json").write_text(json.dumps(doc) + "\n" + json.dumps(doc) + "\n")
    for k in (1, 2):
        ingest.ingest(ingest.document_stream(spark, str(src)), dataset("eqr"), out, str(tmp_path / "cp"), once=True).awaitTermination()
        (src / "2.json").write_text(json.dumps(doc | {"document_id": "d1", "arrived": "2026-01-01T01:00:00Z"}))
    last = ReleaseTable(spark, out).read()
    assert {r.document_id: r.n for r in last.groupBy("document_id").agg(F.count(F.lit(1)).alias("n")).collect()} == {"d0": 7, "d1": 7}


def test_close_rates_equal_brute_force(spark):
    draw = random.Random(5)
    rates = [None, float("nan"), float("inf"), 0.0, 15.0, -15.0, 15.15, 14.85, 1e6, 1.01e6, -1e6] + [draw.choice((1, 20, 3000)) * draw.uniform(-1, 1) for _ in range(300)]
    told = [("a", x) for x in rates[:80]] + [(None, 3.0), ("c", None)]
    asked = [(k, x) for k in ("a", None, "b", "c") for x in rates] + [("a", x * f) for x in rates[3:80] for f in (0.98, 0.9901, 0.9999, 1.0099, 1.02)]
    text_rows = spark.createDataFrame(told, "key string, rate double")
    rows = spark.createDataFrame([(i, k, x) for i, (k, x) in enumerate(asked)], "i int, key string, rate double")
    got = {r.i: r.close for r in reconcile.close_rate_exists(rows, text_rows, ["key"]).collect()}
    fit = lambda x: x is not None and math.isfinite(x)
    near = lambda x, t: fit(x) and fit(t) and abs(x - t) <= max(0.15, 0.01 * abs(t))
    assert got == {i: any(k == l and near(x, t) for l, t in told) for i, (k, x) in enumerate(asked)}
    assert 0 < sum(got.values()) < len(got)
    assert not any(r.close for r in reconcile.close_rate_exists(rows, text_rows.limit(0), ["key"]).collect())


def test_risk_coverage_orders_ties_over_ranges(spark):
    rows = [(i, 0.5 if i % 10 else 0.9, i % 3 == 0) for i in range(5000)]
    df = spark.createDataFrame(rows, "record_seq long, score double, correct boolean").repartition(7)
    got = [tuple(r) for r in evaluate.risk_coverage(df).orderBy("rank").collect()]
    want, k = [], 0
    for n, (_, score, correct) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1):
        k += correct
        want.append((n, score, k / n))
    assert [(g[0], g[3]) for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) <= 5.1e-5 for g, w in zip(got, want))
    assert evaluate.risk_coverage(df.limit(0)).count() == 0


def test_last_and_first_rows_by_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), (None, 2, "y"), (None, None, "z"), ("b", None, "w")], "key string, record_seq int, v string")
    assert sorted(map(tuple, verify.last_by(df, ["key"], "record_seq").collect()), key=str) == sorted([("a", 3, None), (None, 2, "y"), ("b", None, "w")], key=str)
    assert sorted(map(tuple, text.first_by_content(df, "record_seq", "key").collect()), key=str) == sorted([("a", 1, "x"), (None, None, "z"), ("b", None, "w")], key=str)


def test_fuse_leaves_out_missing_signals(spark):
    one = lambda score, ok, weight: f"named_struct('name', 'n', 'score', {score}, 'ok', {ok}, 'weight', {weight}, 'detail', '')"
    row = lambda *parts: spark.range(1).select(verify.fuse(F.array(*[F.expr(p).cast(verify.SIGNAL) for p in parts]))).first()[0]
    assert row(one("0.25D", "true", "1D"), one("null", "null", "9D"), "null", one("1D", "null", "1D")) == 0.5
    assert row(one("null", "null", "1D"), "null") == verify.DEFAULT_TRUST
    assert row(one("0.9D", "false", "1D")) == verify.FAIL_CEILING
