"""Fill-in-the-middle, collocations and license scan against brute force, on awkward tables; losses that were mended."""

import hashlib
import random
import re
import re._parser as parser
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from attestor.llm import collocations, fill_in_middle, license_rules, license_scan, mixing, ngram_join, queries, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, fim string, licenses int, _h long, _row string"


def write(spark, path, rows):
    spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


# ---------------------------------------------------------------- fill in the middle


def middle_rows():
    r = random.Random(1)
    texts = [None, "", "a", "é😀z", "x<P>y", "<S>", "q <M", "日本語" * 50, "\r\n\r\n", "tail<", "plain words here " * 300, "ab́c" * 999]
    texts += ["".join(r.choice("aé😀<PSM> \n") for _ in range(r.randint(0, 60))) for _ in range(150)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    return [*rows, rows[7], rows[7], (None, "no id", None, None)]


def middle(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    text = text or ""
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_middle_query_equals_slices(spark, tmp_path):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = middle_rows()
    got = [tuple(r) for r in queries.op11_fill_in_middle(spark, write(spark, tmp_path, rows)).collect()]
    want = []
    for i, t, *_ in rows:
        n, form, a, m, out = middle(i, t)
        want.append((i, n, form, a, m, sha(out), sha(t or "")))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[2] for r in want} == {"plain", "psm", "spm"}


def test_middle_keeps_columns_and_takes_empty_tables(spark):
    df = spark.createDataFrame([(1, "abc", "en", "s", "x", 1, 2, "y")], SCHEMA)
    out = fill_in_middle.fill_in_middle(df)
    assert set(out.columns) == set(df.columns) and out.first()["fim"]["n"] == 3
    assert fill_in_middle.fill_in_middle(df.where("false")).count() == 0


@pytest.mark.parametrize("size", [1, 2, 63, 64, 65, 1000])
def test_ranked_bits(size):
    r = random.Random(size)
    mask = r.getrandbits(size) | 1
    places = [i for i in range(size) if mask >> i & 1]
    assert [fill_in_middle.ranked_bit(mask, k) for k in range(len(places))] == places


@pytest.mark.parametrize("text", ["", "a", " a  b\n", "one two", "a\r\nb\rc\n\nd", "\n", "é é\r", "  ", "x\ty z "])
def test_units_partition_the_text(text):
    data = text.encode()
    cuts = {"characters": list(text), "words": re.findall(r"^\s*\S*\s*|\S+\s*", text) if text else [], "lines": text.splitlines(keepends=True)}
    for name, parts in cuts.items():
        mask = fill_in_middle.UNITS[name](data) if data else 0
        starts, at = [], 0
        for p in parts:
            if p:
                starts.append(at)
            at += len(p.encode())
        assert [i for i in range(len(data)) if mask >> i & 1] == starts, (name, text)


def test_middle_of_a_huge_text(spark):
    text = "日a😀 " * 700_000  # some 6 MB of UTF-8
    df = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    f = F.col("fim")
    got = fill_in_middle.fill_in_middle(df).select("doc_id", f["form"], f["n"], F.sha2(f["output"], 256), fill_in_middle.restored(f["output"], f["form"]) == F.col("text")).collect()
    for i, form, n, out, same in got:
        want = middle(i, text)
        assert (form, n, out) == (want[1], len(text), hashlib.sha256(want[4].encode()).hexdigest()) and same


# ---------------------------------------------------------------- collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrases(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang in f:
        cand = {p: a for p, a in f[lang].items() if len(p) > 1 and a >= least}
        best = {}
        for p, a in cand.items():
            cuts = [(1000 * a * n[lang] // (f[lang][p[:k]] * f[lang][p[k:]]), k, f[lang][p[:k]], f[lang][p[k:]]) for k in range(1, len(p))]
            best[p] = min(cuts)
        inside = set()
        for q, b in cand.items():
            for m in range(2, len(q)):
                inside |= {q[i : i + m] for i in range(len(q) - m + 1) if 100 * b >= 100 * cand[q[i : i + m]]}
        kept = sorted(((-best[p][0], -a, " ".join(p).encode(), a, *best[p][2:]) for p, a in cand.items() if p not in inside))[:top]
        out += [(lang, i, t.decode(), a, left, right, n[lang], -s) for i, (s, _, t, a, left, right) in enumerate(kept, 1)]
    return sorted(out)


def collocation_rows(seed=2, n=240):
    r = random.Random(seed)
    vocab = ["new", "York", "city", "of", "the", "a\x00b", "é", "日本", "x y", "in", "as", "well"]
    rows = []
    for i in range(n):
        w = [r.choice(vocab) for _ in range(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            at = r.randint(0, len(w))
            w[at:at] = r.choice([["new", "york"], ["as", "well", "as"], ["NEW", "York", "city", "of", "the"]])
        sep = lambda: r.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", " ! "])
        rows.append((i, "".join(x + sep() for x in w), r.choice(["en", "fr", None]), "s"))
    rows += [(n, None, "en", "s"), (n + 1, "", "de", "s"), (n + 2, "NEW York " * 700 + "end", "fr", "s"), rows[5], rows[5]]
    return [(i, t if t is None else t.replace("\x00", "\x01"), lang, s) for i, t, lang, s in rows]


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("bits", "most"), [(26, 1 << 20), (9, 1 << 20), (14, 64), (14, 700)])
def test_collocations_equal_brute_force(spark, bits, most):
    rows = collocation_rows()
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(3)
    assert found(collocations.collocations(df, least=12, top=40, bits=bits, most=most)) == phrases(rows, 12, 40)


def test_collocation_query_and_empty_tables(spark, tmp_path):
    rows = collocation_rows(4, 900)
    want = phrases(rows, 100, 2000)
    assert found(queries.op12_collocations(spark, write(spark, tmp_path, rows))) == want and want
    empty = spark.createDataFrame([], SCHEMA)
    assert found(collocations.collocations(empty, bits=10)) == []


def test_counts_leave_a_task_whole_and_merge_by_block():
    held, batches = collocations.Held(3, most=10), []
    r = np.random.default_rng(0)
    want = Counter()
    for _ in range(40):
        k = r.integers(0, 30, 4)
        want.update(k.tolist())
        batches += held.add(pa.table([["en"] * 4, pa.array([1] * 4, pa.int32()), pa.array([str(x).encode() for x in k], pa.binary()), pa.array([1] * 4, pa.int64())], names=held.NAMES))
    batches += held.all()
    assert len(batches) > 1 and not [*held.all()]
    rows = pa.concat_tables([pa.table(b) for b in batches]).sort_by("block")
    got = Counter()
    for b in collocations._merged(iter(rows.to_batches(max_chunksize=7)), 5):
        got.update({int(p): f for p, f in zip(b["phrase"].to_pylist(), b["f"].to_pylist(), strict=True)})
    assert got == {k: n for k, n in want.items() if n >= 5}


def test_words_with_one_hash_are_told_apart(monkeypatch):
    s = next(collocations.slices(pa.array(["aa bb aa bb aa"])))[1]
    s.w.hashes[:] = 7  # as if all words had one hash
    bits = np.full((2, 1 << 7), 0xFF, np.uint8)
    got = {(m, p.as_py()): int(k) for m, _, ph, n in collocations._counts(s, np.zeros(1, int), np.zeros(1, np.uint64), bits, 10) for p, k in zip(ph, n, strict=True)}
    assert got[1, b"aa"] == 3 and got[1, b"bb"] == 2 and got[2, b"aa bb"] == 2 and got[5, b"aa bb aa bb aa"] == 1


def test_scores_are_exact_beyond_64_bits(spark):
    a, n, left, right = 9_007_199_254_740_993, 9_999_999_999_999_937, 9_007_199_254_740_997, 9_007_199_254_740_999
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in (("a", a), ("n", n), ("l", left), ("r", right))])
    got = row.select(F.expr("(cast(1000 as decimal(5,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")).first()[0]
    assert got == 1000 * a * n // (left * right)


# ---------------------------------------------------------------- license scan


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER).encode())


def scan(text, rules):
    line = b" ".join(words_of(text)).decode()
    starts = {0: 0}
    for i, m in enumerate(re.finditer(" ", line), 1):
        starts[m.end()] = i
    held = set(line.split(" "))

    def places(pattern):
        return [(starts[m.start()], len(m.group().split(" "))) for m in re.finditer(rf"(?<![^ ])(?:{pattern})(?![^ ])", line)] if line else []

    base = [(s, n, label) for phrase, label in license_scan.BASE for s, n in places(phrase)]
    every = [(s, n, p, k, label) for k, (p, label, word, pattern) in enumerate(rules) if word in held for s, n in places(pattern)]

    def beaten(d):
        s, n, p, k, _ = d
        return any(o[0] <= s and o[0] + o[1] >= s + n and (o[2] > p or o[2] == p and (o[1] > n or o[1] == n and o[3] < k)) for o in every)

    return base, sorted(d for d in every if not beaten(d))


def sample(pattern, r):
    """A text that a pattern matches."""

    def made(nodes):
        out = ""
        for op, arg in nodes:
            name = str(op)
            if name == "LITERAL":
                out += chr(arg)
            elif name == "IN":
                kind, what = r.choice(arg)
                out += chr(what) if str(kind) == "LITERAL" else chr(r.randint(*what))
            elif name == "BRANCH":
                out += made(r.choice(arg[1]))
            elif name == "SUBPATTERN":
                out += made(arg[3])
            elif name == "MAX_REPEAT":
                low, high, inner = arg
                out += "".join(made(inner) for _ in range(r.randint(low, min(int(high), low + 2))))
            else:
                raise AssertionError(name)
        return out

    return made(parser.parse(pattern))


def license_rows():
    r = random.Random(3)
    rules = license_rules.rules()
    bits = [sample(p, r) for _, _, _, p in rules for _ in range(2)]
    texts = [None, "", " \n", "Licensed under CC-BY 4.0, cc by cc by", "GNU Lesser General Public License, version 2.1", "All Rights Reserved.", "é all rights reservedé", "mit mit mit license"]
    for _ in range(160):
        parts = [r.choice(bits) if r.random() < 0.5 else r.choice(["word", "license", "the", "©", "All rights reserved;", "GENERAL public License", "copyright 2020"]) for _ in range(r.randint(1, 9))]
        texts.append(r.choice([" ", "\n", ", ", " -- "]).join(x.upper() if r.random() < 0.2 else x for x in parts))
    texts.append("filler words " * 400 + "cc by " * 300 + "all rights reserved, mit license. " * 90 + "tail")
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    return [*rows, rows[8], (None, "cc by", None, None)]


def test_license_query_equals_brute_force(spark, tmp_path):
    rules, rows = license_rules.rules(), license_rows()
    got = [tuple(r) for r in queries.op13_license_scan(spark, write(spark, tmp_path, rows)).collect()]
    want = []
    for i, t, *_ in rows:
        base, kept = scan(t, rules)
        label = lambda xs: ",".join(sorted(set(xs)))
        score = max([license_scan.WORTH[d[2]] for d in kept] + [0.4] * bool(base), default=0.0)
        starts = [b[0] for b in base]
        want.append((i, len(words_of(t)), len(base), min(starts, default=None), max(starts, default=None), label(b[2] for b in base), label([b[2] for b in base] + [d[4] for d in kept]), score))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_license_spans_and_columns(spark):
    rules = [(1, "low", "b", "a b c"), (3, "high", "b", "b"), (3, "same", "b", "b"), (2, "wide", "c", "a b c d"), (2, "part", "d", "d e")]
    df = spark.createDataFrame([(1, "x A b. c, d e", "en", "s", "x", 1, 2, "y")], SCHEMA)
    out = license_scan.scan_licenses(df, rules)
    got = [(d.start, d.size, d.label) for d in out.first()["licenses"]["found"]]
    assert got == [(1, 4, "wide"), (2, 1, "high"), (4, 2, "part")] and set(out.columns) == set(df.columns)
    assert license_scan.scan_licenses(df.where("false")).count() == 0


def test_every_rule_holds_its_keyword_and_is_found(spark):
    r, rules = random.Random(9), license_rules.rules()
    assert len(rules) > 200 and len({(p, label, x) for p, label, _, x in rules}) == len(rules)
    texts = [sample(pattern, r) for _, _, _, pattern in rules]
    for (_, _, word, pattern), text in zip(rules, texts, strict=True):
        assert word in text.split(" "), (word, pattern, text)
        assert "(" not in pattern.replace("(?:", "") and "*" not in pattern and not re.search(r"(?<!\])\+", pattern)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in license_scan.scan_licenses(df).collect():
        assert any(d.priority >= rules[row.doc_id][0] for d in row.licenses.found), texts[row.doc_id]


def test_many_detections_resolve_as_brute_force(spark):
    rules = [(1, "a", "a", "a b"), (2, "b", "b", "b c a b"), (2, "c", "c", "c(?: a)?"), (3, "d", "a", "a b c a b c a")]
    text = " ".join(random.Random(5).choice(["a b c", "a b", "c", "a b c a b c a", "x"]) for _ in range(1500))
    got = license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string"), rules).first().licenses.found
    assert [(d.start, d.size, d.priority, d.rule, d.label) for d in got] == scan(text, rules)[1]


# ---------------------------------------------------------------- losses that were mended


def prose(seed, n=40):
    r = random.Random(seed)
    return " ".join(f"w{r.randint(0, 5000)}" for _ in range(n))


def test_one_of_each_class_keeps_every_different_text(spark):
    a, b, c, d = (prose(k) for k in range(4))
    rows = [(1, a), (5, a), (5, b), (7, c), (7, d), (7, d), (8, d + " tail"), (9, None), (9, ""), (None, a), (None, a)]
    df = spark.createDataFrame([(i, t, "en", "s", "x", 1, 2, "y") for i, t in rows], SCHEMA)
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(df).collect()), key=str)
    assert kept == sorted([(1, a), (5, b), (7, c), (7, d), (9, None), (9, ""), (None, a), (None, a)], key=str)
    assert ngram_join.keep_one(df.where("false")).count() == 0 and ngram_join.keep_one(df).columns == df.columns


def test_take_counts_each_text_of_an_id(spark):
    rows = [(1, "", "s"), (1, prose(1), "s"), (None, prose(2), "s"), (None, prose(3), "t"), (2, prose(4), "t"), (2, prose(4), "t"), (2, prose(4), None), (3, prose(5), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(df).collect()
    want = Counter()
    for r in mixed:
        if r["size"]:
            want[r.doc_id, r.source] += int(r.taken / r["size"] + 0.5)
    got = Counter((r.doc_id, r.source) for r in mixing.take(df).collect())
    assert got == +want and all(r.text for r in mixing.take(df).collect())


def test_a_huge_labelled_text_does_not_end_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 100_000)
    rows = [(i, prose(i, 10)) for i in range(300)] + [(1000 + i, "x" * 200_000) for i in range(20)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = toxicity.labelled_sample(df, labels)
    assert len(got) == 300 and all(len(t) < 1000 for t, _, _ in got)
