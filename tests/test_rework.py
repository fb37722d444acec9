"""Joins of names, running sums, group axioms, release tables, run states, fetches, answers, figure pages and samples, against brute force."""

import itertools
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from attestor.operators import analysis, answers, batches, constraints, contain, evaluate, extract, gate, reconcile, verify, vision
from attestor.operators.ranges import running
from attestor.operators.release_table import Conflict, ReleaseTable
from attestor.plans.datasets import dataset
from attestor.sources.fetch import FetchStore, by_fetcher, by_record
from attestor.sources.store import Folder

norm = lambda s: None if s is None else re.sub("[^a-z0-9]", "", s.lower())


def names(seed, n, keys=("a", "b", None)):
    r = random.Random(seed)
    make = lambda: "".join(r.choice("abAB -") for _ in range(r.choice([0, 1, 3, 5, 6, 7, 9, 14])))
    rows = [(i, r.choice(keys), make(), round(r.random(), 3) if r.random() < 0.7 else None) for i in range(n)]
    return [*rows, (n, "a", None, 1.0), (n + 1, "c", "only here", 2.0)]


DDL = "record_seq long, page string, name string, rate double"


@pytest.fixture(scope="module")
def sides(spark):
    a, b = names(1, 120), [(i + 1000, *r) for i, *r in names(2, 90)]
    return (a, spark.createDataFrame(a, DDL)), (b, spark.createDataFrame(b, DDL))


def test_fuzzy_found_equals_all_pairs(sides):
    (a, left), (b, right) = sides
    got = {(r.page, r.name): r.found for r in reconcile.fuzzy_found(left, right, ["page"], "name", prefix=3, width=8).collect()}
    cut = lambda s: None if s is None else norm(s)[:8]
    want = {}
    for _, p, x, _ in a:
        x = cut(x)
        want[p, x] = x is not None and any(q == p and (y := cut(o)) is not None and (x in y or y in x or x[:3] == y[:3]) for _, q, o, _ in b)
    assert got == want


def test_best_match_equals_all_pairs(sides):
    (a, left), (b, right) = sides
    got = {r.record_seq: (r.matched, r.match_rate) for r in reconcile.best_match(left, right, ["page"], "name").collect()}
    for seq, p, x, _ in a:
        fits = [(rate is None, s, rate) for s, q, y, rate in b if q == p and x is not None and y is not None and (norm(x) in norm(y) or norm(y) in norm(x))]
        best = min(fits, key=lambda t: t[:2], default=None)
        assert got[seq] == ((True, best[2]) if best else (False, None)), (seq, x)
    assert len(got) == len(a)


def test_overlaps_equal_all_pairs(sides):
    (a, left), (b, right) = sides
    got = sorted(((r.record_seq, r.cand_name, r.overlap) for r in reconcile.overlapping(right, left, ["page"], "name").collect()), key=str)
    runs = lambda s: {s[i : i + 6] for i in range(len(s) - 5)}
    want = []
    for seq, p, x, _ in a:
        page = {y for _, q, y, _ in b if q == p}
        meets = {y for y in page if x is not None and y is not None and (norm(x) in norm(y) or norm(y) in norm(x) or runs(norm(x)) & runs(norm(y)))}
        want += [(seq, y, True) for y in meets] or [(seq, y, False) for y in page]
    assert got == sorted(want, key=str)


def test_a_key_with_most_rows_meets_only_what_shares_a_run(spark):
    rows = spark.range(3000).select((F.col("id") < 3000).cast("string").alias("page"), F.concat(F.lit("n"), F.sha1(F.col("id").cast("string"))).alias("name"), F.col("id").alias("record_seq"), F.lit(1.0).alias("rate"))
    keyed = rows.select(contain.key(["page"]).alias("_key"), F.col("name"))
    met = contain.holding(keyed.select("_key", F.substring("name", 3, 12).alias("name")), keyed)
    assert met.count() >= 3000 and met.where("needle = hay").count() == 0
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_running_sums_over_ranges(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["x", "y", None]), r.choice([0.1, 0.5, 0.5, 0.9, None]), r.randint(0, 5)) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, g string, s double, v int")
    for by, size in itertools.product(([], ["g"]), (7, 100, 10_000)):
        got = running(df, [-F.col("s"), F.col("id")], {"total": F.col("v"), "n": F.lit(1)}, by, rows=size).collect()
        assert len(got) == 700
        order = sorted(rows, key=lambda t: (t[2] is not None, -(t[2] or 0), t[0]))
        sums, counts = {}, {}
        want = {}
        for i, g, _, v in order:
            k = g if by else 0
            sums[k], counts[k] = sums.get(k, 0) + v, counts.get(k, 0) + 1
            want[i] = (sums[k], counts[k])
        assert {x.id: (x.total, x.n) for x in got} == want
        assert all(x.n_all == counts[x.g if by else 0] for x in got)
    assert running(df.where("false"), [F.col("id")], {"total": F.col("v")}).count() == 0


def test_thresholds_take_ties_together(spark):
    rows = [(0.9, True, "a")] * 60 + [(0.5, i % 3 > 0, "a") for i in range(30)] + [(0.9, False, "b")] * 5
    df = spark.createDataFrame(rows, "score double, correct boolean, g string")
    assert gate.thresholds(df.where("g = 'a'"), 0.3, 0.05).first().threshold == 0.5
    assert {r.g: r.threshold for r in gate.thresholds(df, 0.3, 0.05, "g").collect()} == {"a": 0.5, "b": None}
    assert gate.thresholds(df.where("false"), 0.3, 0.05).first().threshold is None


def test_group_axioms_without_windows(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i}", None if i % 2 else "p") for i in range(300)]
    df = spark.createDataFrame(rows, "record_seq long, a string, b string")
    rule = constraints.duplicate_grain(F.col("record_seq") < 200, ("a", F.col("b")), "again")
    out = rule.prepare(df).select("record_seq", rule.outcome.alias("ok"), rule.detail.alias("detail"))
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.record_seq: (r.ok, r.detail) for r in out.collect()}
    n = {p: sum(1 for i, a, b in rows if i < 200 and a == "hot" and b == p) for p in ("p", None)}
    assert len(got) == 300 and all(got[i] == ((False, f"again (x{n[b]})") if a == "hot" and i < 200 else (None, None)) for i, a, b in rows)


def test_release_table_rewrites_touched_buckets_only(spark, tmp_path):
    table = ReleaseTable(spark, f"file://{tmp_path}/r", n_buckets=16)
    docs = spark.range(200).select(F.col("id").cast("string").alias("document_id"))
    rows = docs.withColumn("v", F.lit(1))
    first = table.merge(rows, docs, "w", 0)
    assert table.read().count() == 200 and len(first.buckets) == 16
    one = docs.where("document_id = '7'")
    second = table.merge(one.withColumns({"v": F.lit(2), "more": F.lit("x")}), one, "w", 5)  # numbers may be skipped
    changed = [b for b in first.buckets if first.buckets[b] != second.buckets[b]]
    assert len(changed) == 1
    written = list((tmp_path / "r" / "data" / second.buckets[changed[0]][0]).glob("bucket=*"))
    assert [p.name for p in written] == [f"bucket={changed[0]}"]
    assert {(r.v, r.more): r["count"] for r in table.read().groupBy("v", "more").count().collect()} == {(1, None): 199, (2, "x"): 1}
    assert table.merge(one.withColumn("v", F.lit(9)), one, "w", 5).number == 1 and table.merge(one.withColumn("v", F.lit(9)), one, "w", 2).number == 1
    assert table.read().where("v = 9").count() == 0 and table.read(0).count() == 200
    table.merge(rows.where("false"), one, "w", 6)
    assert table.read().count() == 199
    added = table.append(one.withColumn("v", F.lit(3)))
    assert table.read().count() == 200 and table.version().number == added.number
    assert not Folder(spark, f"{table.path}/log").put(f"{added.number:012d}.json", {})  # a second writer of a version loses
    assert table.vacuum() > 0 and table.read().count() == 200
    assert issubclass(Conflict, RuntimeError)


def test_batch_runs_are_taken_up_again(spark, tmp_path):
    folder = f"file://{tmp_path}/runs"
    asked = spark.range(25).select(F.col("id").cast("string").alias("custom_id"), F.lit("c").alias("chunk"))
    sent = []

    def submit(rows):
        if len(sent) == 2:
            raise ConnectionError("driver lost")
        sent.append(sorted(r.custom_id for r in rows.collect()))
        return f"b{len(sent)}"

    with pytest.raises(ConnectionError):
        batches.start(asked, "d", submit, folder, block=5)
    store = batches.RunStore(asked, folder)
    assert store.load("d").batch_ids == ["b1", "b2"] and not store.load("d").complete
    early = list(sent)
    sent.clear()
    run = batches.start(asked, "d", lambda rows: sent.append(sorted(r.custom_id for r in rows.collect())) or f"c{len(sent)}", folder, block=5)
    assert run.resumed and run.complete and run.batch_ids[:2] == ["b1", "b2"]
    assert sorted(sum(early + sent, [])) == sorted(str(i) for i in range(25))  # each request in one batch
    again = batches.start(asked, "d", lambda rows: pytest.fail("submitted twice"), folder, block=5)
    assert again.batch_ids == run.batch_ids
    written = []
    state = {b: "ended" for b in run.batch_ids} | {"b2": "running"}
    fetch = lambda ids: spark.createDataFrame([(i,) for i in ids], "id string")
    assert batches.finish(asked, "d", state.get, fetch, written.append, folder) == ("pending", ["b2"])
    state["b2"] = "ended"
    with pytest.raises(OSError):
        batches.finish(asked, "d", state.get, fetch, lambda df: (_ for _ in ()).throw(OSError("disk")), folder)
    assert batches.finish(asked, "d", state.get, fetch, written.append, folder) == ("ended", run.batch_ids) and written[0].count() == len(run.batch_ids)
    assert store.load("d") is None and batches.finish(asked, "d", state.get, fetch, written.append, folder) == ("none", [])
    fewer = batches.start(asked.limit(3), "d", lambda rows: "z", folder)
    changed = batches.start(asked, "d", lambda rows: "y", folder)
    assert fewer.batch_ids == ["z"] and changed.batch_ids == ["y"] and not changed.resumed


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _two_readings(spark):
    from attestor import queries as Q

    r = Q.measures(spark, "/root/testdata/sf0.001")
    return r, Q.second_reading(r), Q


def test_counted_records_build_no_messages(spark):
    """What only needs the status or the trust makes no flag, no detail and no array of signals."""
    r, second, q = _two_readings(spark)
    for columns in (["qa_status"], ["trust_score", "qa_status", "review_recommended"]):
        plan = _plan(verify.verify(r, q.EQR.axioms()).select(*columns))
        assert "disagrees with implied" not in plan and "logical contradiction" not in plan
    plan = _plan(verify.verify(r, q.EQR.axioms(), second=second, keys=q.KEYS, fields=q.EQR.ensemble_fields).select("trust_score"))
    assert "models disagree" not in plan and "disagrees with implied" not in plan
    assert _plan(q.duplicate_grain(spark, "/root/testdata/sf0.001")).count("disagrees with implied") == 1  # built once
    assert "regexp" not in _plan(analysis.mean_rate_by_state(verify.verify(r, q.EQR.axioms()), ["brand"]))


def test_readings_meet_by_one_hash_and_needed_columns(spark):
    """Rows are sorted by a hash of the keys, and the last reading of a key carries no column that is not compared."""
    r, second, q = _two_readings(spark)
    wide = second.withColumn("note", F.repeat(F.lit("x"), 1000))
    for df in (verify.reconcile(r, wide, q.KEYS, q.EQR.ensemble_fields), reconcile.compare_rates(wide, r, q.KEYS)):
        assert "repeat(" not in _plan(df) and "Join LeftOuter, " in _plan(df) and "xxhash64" in _plan(df)


def test_hashes_that_meet_are_looked_at(spark):
    """xxhash64 passes nulls over, so these keys share it; they are no match."""
    rows = "a string, b string, v int, record_seq int"
    one = spark.createDataFrame([(None, "x", 1, 1), ("x", None, 2, 2), (None, None, 3, 3)], rows)
    two = spark.createDataFrame([("x", None, 2, 1)], rows)
    got = {r.v: r._ensemble.score for r in verify.reconcile(one, two, ["a", "b"], ["v"]).collect()}
    assert got == {1: 0.5, 2: 1.0, 3: 0.5}
    assert [r.v for r in verify.omissions(one.where("v = 1"), two, ["a", "b"]).collect()] == [2]
    rule = constraints.duplicate_grain(F.lit(True), ("a", "b"), "again")
    twice = rule.prepare(one.unionByName(two)).withColumn("ok", rule.outcome).where("ok = false").select("v", "_grain_rows").collect()
    assert sorted(map(tuple, twice)) == [(2, 2), (2, 2)]


def test_many_batches_are_cut_once_and_submitted_together(spark, tmp_path):
    """Neither the jobs nor the reads of the requests grow with the number of blocks."""
    reads = spark.sparkContext.accumulator(0)

    def seen(batches_):
        for b in batches_:
            reads.add(len(b))
            yield b

    asked = spark.range(600).select(F.col("id").cast("string").alias("custom_id"), F.lit("c").alias("chunk")).mapInPandas(seen, "custom_id string, chunk string")
    folder, got, calls = f"file://{tmp_path}/runs", {}, []

    def submit(some):
        calls.append(1)
        if len(calls) == 3:
            raise ConnectionError("driver lost")
        for r in some.collect():
            got.setdefault(r.block, []).append(r.custom_id)
        return {r.block: f"b{r.block}" for r in some.select("block").distinct().collect()}

    with pytest.raises(ConnectionError):
        batches.start(asked, "d", batches.Together(submit, 40), folder, block=2)
    assert len(batches.RunStore(asked, folder).load("d").batch_ids) == 80
    run = batches.start(asked, "d", batches.Together(submit, 40), folder, block=2)
    assert run.resumed and run.complete and len(run.batch_ids) == 300 and len(calls) == 9
    assert sorted(sum(got.values(), []), key=int) == [str(i) for i in range(600)]
    assert all(run.batch_ids[b] == f"b{b}" for b in got) and all(not x or b in got for b, x in enumerate(run.batch_ids))
    assert reads.value <= 4 * 600  # counted and cut, in either start
    each = batches.start(asked.where("custom_id < '3'"), "e", lambda rows: str(rows.count()), folder, block=20)
    assert sum(map(int, each.batch_ids)) == 223 and reads.value <= 6 * 600
    assert not [p for p in (tmp_path / "runs").iterdir() if p.name.startswith("_cut")]


def test_fetches_are_stored_once(spark, tmp_path):
    store = FetchStore(spark, f"file://{tmp_path}/f", 4)
    urls = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u1",), ("",), (None,), ("bad",)], "url string")
    calls = tmp_path / "calls"

    def get(url):
        with calls.open("a") as f:
            f.write(url + "\n")
        if url == "bad":
            raise OSError("no answer")
        return b"<html>same</html>" if url in ("u1", "u2") else b"%PDF-1"

    assert store.fetch(urls, lambda u: by_fetcher(u, get, retries=2, wait=0)) == 4
    rows = {r.url: r for r in store.fetched.collect()}
    assert rows["u1"].document_id == rows["u2"].document_id != rows["u3"].document_id and rows["bad"].error == "OSError: no answer"
    assert sorted((r.mime, r.n_bytes) for r in store.objects.collect()) == [("application/pdf", 6), ("text/html", 17)]
    assert sorted(calls.read_text().split()) == ["bad", "bad", "u1", "u2", "u3"]
    more = urls.union(spark.createDataFrame([("u4",)], "url string"))
    recorded = spark.createDataFrame([("u4", b"%PDF-1"), ("u1", b"other")], "url string, content binary")
    assert store.fetch(more, lambda u: by_record(u, recorded)) == 2  # u4, and the failed one again
    assert store.objects.count() == 2 and store.fetched.where("url = 'bad'").first().tries == 2 and store.fetched.where("ok").count() == 4


@pytest.mark.parametrize(
    ("said", "want"),
    [
        ('```json\n{"a": {"b": [1, "}"]}} \n``` and {more}', '{"a": {"b": [1, "}"]}}'),
        ('x [1, [2, "]\\\\"], 3] y]', '[1, [2, "]\\\\"], 3]'),
        ('{"a": "\\"} {"}', '{"a": "\\"} {"}'),
        ('{"a": [1, 2}', None),
        ('{"a": "never closed}', None),
        ("nothing", None),
        (None, None),
        ('{"a": "' + "\\n" * 30_000 + '"} tail', '{"a": "' + "\\n" * 30_000 + '"}'),
    ],
)
def test_first_value(spark, said, want):
    got = spark.createDataFrame([(said,)], "t string").select(answers.first_value(F.col("t")).alias("v")).first().v
    assert got == want and (got is None or json.loads(got) is not None)


def test_listed_and_salvaged_answers(spark):
    rows = [('Sure: {"records": [{"k": 1}, 2]} or so}',), ("[[1], 2] x",), ('{"other": []}',), (None,), ("{broken",)]
    got = spark.createDataFrame(rows, "t string").select(F.size(answers.listed(F.col("t"))).alias("n"), answers.value(F.col("t")).isNotNull().alias("v")).collect()
    assert [r.n for r in got] == [2, 2, 0, 0, 0] and [r.v for r in got] == [True, True, True, False, False]


def test_vision_pages_override_and_escalate(spark):
    ds = dataset("eqr")
    pages = spark.createDataFrame(
        [("d", 1, "Figure 1", 1, 0, b"one"), ("d", 2, "no caption", 5, 50, b"two"), ("d", 3, " Chart 2 b", 0, 12, b"three"), ("d", 4, "Exhibit 3", 0, 11, b"four"), ("e", 1, "FIGURE 9", 1, 1, b"boom")],
        "document_id string, page_no int, body string, n_images int, n_drawings int, image binary",
    )
    item = '{"quality_measures": [{"plan_name": "P", "measure_name": "%s", "reporting_year": 2023, "rate": 5, "page": 77}]}'

    def cheap(image):
        if image == b"boom":
            raise OSError("down")
        return item % "first" if image == b"one" else '{"quality_measures": []}'

    asked = vision.page_requests(pages)
    assert sorted((r.document_id, r.page_no) for r in asked.collect()) == [("d", 1), ("d", 3), ("e", 1)]
    read = vision.read_pages(asked, cheap, ds, lambda image: item % "second", retries=2, wait=0)
    docs = spark.createDataFrame([(0, "d", "u", "TX", None, None, 2023, "t"), (1, "e", "v", "TX", None, None, 2023, "t")], "ordinal long, document_id string, source_url string, jurisdiction string, program string, publisher string, report_year int, text string")
    got = extract.extractor("vision")(vision.routed(read, docs), ds).select("measure_name", "provenance.page_start", "provenance.method", "provenance.source_url").collect()
    assert sorted(map(tuple, got)) == [("first", 1, "vision", "u"), ("second", 1, "vision", "v"), ("second", 3, "vision", "u")]
    for name in ("llm", "llm_batch", "vlm", "openai", "payload", "rule"):
        assert callable(extract.extractor(name))
    with pytest.raises(ValueError, match="unknown extractor"):
        extract.extractor("other")


def test_samples_are_exact_and_nested(spark):
    rows = [(f"u{i % 150}", "hot" if i % 3 else f"s{i % 9}") for i in range(400)]
    df = spark.createDataFrame(rows, "uid string, g string")
    sample = evaluate.stratified_sample(df, 60, "g", "uid", 5)
    shares = {r.stratum: r.share for r in evaluate.stratum_sizes(df, 60, "g").collect()}
    counts = {r.g: r["count"] for r in sample.groupBy("g").count().collect()}
    assert sum(counts.values()) == min(60, sum(shares.values())) and all(counts[g] <= shares[g] for g in counts)
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, evaluate.stratified_sample(df.repartition(7), 60, "g", "uid", 5).collect()))
    one = df.dropDuplicates(["uid"])
    few, more = (evaluate.double_scored(one, n, "uid", 1).where("double_scored") for n in (10, 25))
    assert few.count() == 10 and more.count() == 25 and few.join(more, "uid", "left_semi").count() == 10
    assert evaluate.double_scored(one, 1000, "uid").where("double_scored").count() == 150


def test_sheets_and_registry_files(spark, tmp_path):
    from attestor.sources import registry, sheets

    content = sheets.write_bytes(["row_uid", "correct", "n"], [("a<&>", True, 1), (None, None, None), ("é\x01", False, 2.5), ("z", "yes", float("nan"))])
    assert sheets.read_bytes(content, "Review") == [["row_uid", "correct", "n"], ["a<&>", "true", "1"], [None, None, None], ["é", "false", "2.5"], ["z", "yes", "nan"]]
    with pytest.raises(KeyError):
        sheets.read_bytes(content, "Other")
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.xlsx").write_bytes(content)
    got = evaluate.labels(sheets.labels(sheets.read_sheets(spark, str(tmp_path / "x")))).collect()
    assert sorted(map(tuple, got)) == [("a<&>", True), ("z", True), ("é", False)]
    fresh = spark.createDataFrame([(2, "u2", 2020, "Ohio", "B"), (1, " u1 ", 2024, "TX", None)], "ordinal int, url string, year int, state string, name string")
    for n in (1, 2):
        assert registry.write_entries(registry.new_entries(fresh, "chna"), "chna", str(tmp_path)) == 2
        assert len(list(tmp_path.glob("*.bak"))) == n - 1
    back = registry.discover(registry.load_sources(spark, "chna", str(tmp_path)), "chna").orderBy("candidate_seq").collect()
    assert [(r.url, r.jurisdiction, r.publisher, r.report_year) for r in back] == [("u1", "TX", "", 2024), ("u2", "OH", "B", 2020)]


def test_digests_are_streamed(spark, tmp_path):
    import hashlib

    from attestor.operators import curate

    data = random.Random(1).randbytes(300_000)
    (tmp_path / "big.bin").write_bytes(data)
    (tmp_path / "one.bin").write_bytes(b"1")
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path")
    got = {r.path.rsplit("/", 1)[1]: r.sha256 for r in curate.file_digests(files, chunk=4096).collect()}
    assert got == {"big.bin": hashlib.sha256(data).hexdigest(), "one.bin": hashlib.sha256(b"1").hexdigest()}
