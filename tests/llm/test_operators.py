"""Every operator on a table with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from attestor.llm import decontaminate, fingerprint, language_id, line_dedup, mixing, ngram_join, sharding, token_counts, toxicity, url_filter, words
from attestor.llm.components import components

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, score double, shard int, hits string, _row string, _n int, _id long"


def prose(seed, n, words_=("alpha", "beta", "gamma", "delta", "omega", "é1", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu")):
    r = random.Random(seed)
    return " ".join(r.choice(words_) + str(r.randint(0, 99)) for _ in range(n))


def awkward():
    long = "\n".join(prose(i, 40) for i in range(60))
    near = prose(5, 120)
    texts = [
        None, "", " \n ", "word", "one two three", "1234 !!", prose(1, 30), prose(1, 30), near, near + " tail", near.replace("alpha", "ALPHA", 1), long,
        long + "\nmore words at the end of it", prose(2, 12) + "\n" + prose(3, 12), prose(2, 12), "日本語 テキスト", "<|endoftext|> x", "a" * 3000,
    ]
    rows = [(i, t, ["en", "fr", None][i % 3], ["s1", None, "s2", "s1"][i % 4], 0.5, 7, "h", "r", 1, 2) for i, t in enumerate(texts)]
    return rows + [rows[6], (None, "no id at all here", None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tokens(t):
    return WORD.findall((t or "").encode().lower())


def test_words_match_the_pattern_everywhere():
    texts = [r[1] for r in awkward()]
    for most in (50, 1 << 20):
        for i, j, w in words.word_slices(pa.array(texts), most):
            raw = w.data.tobytes()
            for k in range(j - i):
                got = [raw[w.starts[x] : w.ends[x]] for x in range(w.first[k], w.first[k + 1])]
                assert got == tokens(texts[i + k])


def test_decontamination_matches_brute_force(spark, docs, empty):
    long = prose(9, 40)
    items = [(1, " ".join(prose(5, 120).split()[20:40])), (2, "One TWO three"), (2, "word"), (3, None), (4, "!!"), (None, "one"), (5, long)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for i, t in items:
        w = tokens(t)
        if i is not None and w:
            for k in range(max(1, len(w) - 12)):
                windows[tuple(w[k : k + min(13, len(w))])].add(str(i))
    for block in (16 << 20, 60):  # one block, and several
        rows = decontaminate.scan(docs.select("doc_id", "text"), bench, block_bytes=block)
        h = F.col("hits")
        got = {(r.doc_id, r.text): r for r in rows.select("doc_id", "text", h["n_words"].alias("n"), decontaminate.n_hit(h).alias("k"), h["items"].alias("i"), decontaminate.contaminated(h).alias("c")).collect()}
        assert len(got) == len(set((r[0], r[1]) for r in awkward()))
        for (_, t), r in got.items():
            w, hit, found = tokens(t), set(), set()
            for k in range(len(w)):
                for g, ids in windows.items():
                    if tuple(w[k : k + len(g)]) == g:
                        hit |= set(range(k, k + len(g)))
                        found |= ids
            assert (r.n, r.k, r.i) == (len(w), len(hit), sorted(found))
            assert r.c == (len(hit) > 0 and 20 * len(hit) >= len(w))
    clean = decontaminate.remove_documents(docs, bench)
    assert clean.columns == docs.columns and {r.hits for r in clean.collect()} <= {"h", None}
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, bench).collect()}
    assert cut[4] == "" and cut[3] == "" and cut[0] is None and cut[6] == awkward()[6][1]
    assert decontaminate.scan(empty, bench).count() == 0
    assert decontaminate.scan(docs, bench.where("false")).where("size(hits.items) > 0").count() == 0


def test_fingerprints(spark, docs, empty):
    got = {(r.doc_id, r.n_chars): r for r in fingerprint.fingerprint_edits(docs).collect()}
    ordered = sorted((r[:2] for r in awkward()), key=lambda r: (r[0] is not None, r[0] or 0))
    fps = {}
    for k, (i, t) in enumerate(ordered):
        t, nxt = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        r = got[(i, len(t))]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        if i != 6:  # of two equal rows one is followed by the other
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint)
        assert fps.setdefault(t, r.fingerprint) == r.fingerprint
    assert len(set(fps.values())) == len(fps)
    assert fingerprint.fingerprint_edits(empty).count() == 0
    ab = spark.createDataFrame([("a. b.\n\nc. d.\n\ne.", "a. b.\n\nc. X.\n\ne.")], "a string, b string").select(fingerprint.fingerprint(F.col("a")).alias("a"), fingerprint.fingerprint(F.col("b")).alias("b"))
    assert ab.select(fingerprint.changed_sections(F.col("a"), F.col("b"))).first()[0] == [1]


def test_token_counts_equal_the_library(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        t = Tokenizer.from_file(public_tokenizers.path(name))
        got = docs.select("text", token_counts.token_count(F.col("text"), public_tokenizers.path(name), huge=200, chunk=100, overlap=4).alias("n")).collect()
        assert all(r.n == len(t.encode(r.text or "", add_special_tokens=False).ids) for r in got)
    r = random.Random(3)
    ends, _, proven = token_counts.load(path)
    assert proven
    bits = ["a", " ", "\n", "b1", "é ", "\t", "'s ", "<|endoftext|>", " the", " ", "!!", "\x1f", "x" * 30]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 200))) for _ in range(400)]
    want = [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]
    assert token_counts.Counter(path)(texts) == want
    for chunk, overlap in ((20, 4), (64, 8)):
        assert [token_counts.spliced(t, ends, chunk, overlap) for t in texts] == want
    assert token_counts.count_tokens(empty, path).count() == 0
    assert {x.n_tokens for x in token_counts.count_tokens(docs.where("text is null"), path).collect()} == {0}


def brute_pairs(texts, k=5, least=0.8):
    sets = []
    for t in texts:
        w = tokens(t)
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    linked = defaultdict(set)
    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) - 1e-9:
                linked[a].add(b)
                linked[b].add(a)
    return linked


def test_ngram_join_matches_brute_force(spark, docs, empty):
    rows = [r[:2] for r in awkward() if r[0] is not None]
    rows += [(100 + i, prose(50, 100) + f" end{i} " + prose(60 + i, i % 4)) for i in range(90)]  # more than a small node
    df = spark.createDataFrame(rows, "doc_id long, text string")
    linked = brute_pairs([t for _, t in rows])
    got = {r.doc_id: r for r in ngram_join.join(df).collect()}
    label = list(range(len(rows)))
    for _ in rows:
        label = [min([label[i], *(label[j] for j in linked[i])]) for i in range(len(rows))]
    for i, (d, _) in enumerate(rows):
        assert got[d].n_links == len(linked[i]), d
        assert got[d].class_id == rows[label[i]][0], d
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    assert ids == sorted({r[0] for r in awkward() if r[0] is not None} - {7, 9, 10, 12})
    assert kept.where("doc_id is null").count() == 1
    assert ngram_join.join(empty).count() == 0
    nulls = {r.doc_id: r for r in ngram_join.join(docs).collect()}
    assert nulls[None].class_id is None and nulls[0].class_id == 0 and nulls[0].n_links == 0


def test_ngram_join_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "SMALL", 5)
    rows = [(i, prose(50, 60) + " " + prose(60 + i, 1 + i % 9)) for i in range(60)]
    linked = brute_pairs([t for _, t in rows])
    got = {r.doc_id: r.n_links for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: len(linked[i]) for i, _ in rows}


def popular_pairs(n):
    """Sketches of pairs of texts at about the threshold, all mixed from the same passages."""
    r = random.Random(8)
    passages = [prose(900 + i, 30) for i in range(80)]
    left, right = [], []
    for _ in range(n):
        a = r.sample(range(80), 23)
        left.append(" ".join(passages[x] for x in a[:21]))
        i, j = r.sample(range(21), 2)
        right.append(" ".join(passages[a[21] if k == i else a[22] if k == j else x] for k, x in enumerate(a[:21])))
    ids = pa.array(range(2 * n), pa.int64())
    got = pa.Table.from_batches(ngram_join._sketches(iter([pa.record_batch([ids, pa.array(left + right)], ["doc_id", "text"])]), 5))
    sketch = ngram_join._matrix(got["sketch"])
    return sketch[:n], sketch[n:]


def test_ngram_join_reaches_its_recall_where_all_nodes_are_large():
    n = 1500
    a, b = popular_pairs(n)
    meet = lambda x, y: set(zip(*(v.tolist() for v in x), strict=True)) & set(zip(*(v.tolist() for v in y), strict=True))
    assert 0.77 < (a == b).mean() < 0.83

    def missed(runs, width=ngram_join.WIDTH):
        nodes = set()
        for r in range(runs):
            start = np.full(n, ngram_join._root(r))
            nodes |= meet(ngram_join._children(a, start, 0.8, width), ngram_join._children(b, start, 0.8, width))
        for _ in range(ngram_join.LEVELS - 1):
            row, path = np.array([x for x, _ in nodes]), np.array([p for _, p in nodes], np.uint64)
            below = []
            for sketch in (a, b):
                at, child = ngram_join._children(sketch[row], path, 0.8, width)
                below.append((row[at], child))
            nodes = meet(*below)
        return n - len({x for x, _ in nodes})

    assert missed(ngram_join.runs_for(ngram_join.RECALL)) == 0
    assert missed(10, 1.0) > 3  # runs and width that were fixed before
    assert ngram_join.miss_rate(10, width=1.0) > 1 / 200 and ngram_join.miss_rate(ngram_join.runs_for(0.99999)) <= 1e-5
    assert ngram_join.runs_for(0.99) < ngram_join.runs_for(0.999) < ngram_join.runs_for(0.99999)
    with pytest.raises(ValueError):
        ngram_join.runs_for(1.0)


def test_ngram_join_of_popular_passages(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL", 1)
    r = random.Random(4)
    passages = [prose(900 + i, 30) for i in range(20)]
    rows = []
    for i in range(60):
        a = r.sample(range(20), 12)
        rows += [(3 * i, " ".join(passages[x] for x in a[:11])), (3 * i + 1, " ".join(passages[x] for x in a[:10] + a[11:])), (3 * i + 2, " ".join(passages[x] for x in a[:10]))]
    linked = brute_pairs([t for _, t in rows])
    got = {x.doc_id: x.n_links for x in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: len(linked[i]) for i, _ in rows}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}


def brute_lines(rows):
    seen, out, sets = set(), defaultdict(list), []
    for d, t in sorted(set(rows), key=lambda r: r[0]):
        for i, line in enumerate((t or "").split("\n")):
            w = tokens(line)
            if not w:
                continue
            s = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
            if any(len(s & x) >= 0.8 * len(s | x) - 1e-9 for x in sets):
                out[d].append(i)
            sets.append(s)
    return out


@pytest.mark.parametrize("small", [24, 3])
def test_line_dedup_matches_brute_force(spark, docs, empty, monkeypatch, small):
    monkeypatch.setattr(line_dedup, "SMALL", small)
    base = prose(70, 60)
    near = [(200 + i, "x\n" + base.replace(base.split()[i], f"new{i}") + "\n" + prose(80 + i, 9)) for i in range(30)]
    rows = [r[:2] for r in awkward() if r[0] is not None] + near
    want = brute_lines(rows)
    df = spark.createDataFrame(rows + [(None, "a b c d e f")], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in line_dedup.find_repeated(df).collect()}
    for d, t in rows:
        assert (got[d].n_lines, got[d].removed) == (len((t or "").split("\n")), want[d]), d
    assert got[None].removed == []
    assert line_dedup.find_repeated(empty).count() == 0
    cut = line_dedup.remove_repeated(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[0] is None and texts[12] == "more words at the end of it" and texts[14] == ""
    line, unique = prose(300, 20), prose(301, 20)
    twice = spark.createDataFrame([(1, line), (2, line + "\nkeep " + prose(302, 9)), (2, unique + "\nmore " + prose(303, 9)), (None, line), (3, "Short one."), (4, "short ONE\n" + unique)], "doc_id long, text string")
    left = sorted((r.doc_id or 0, r.text) for r in line_dedup.remove_repeated(twice).collect())
    assert left == sorted([(0, line), (1, line), (2, "keep " + prose(302, 9)), (2, unique + "\nmore " + prose(303, 9)), (3, "Short one."), (4, "")])


def test_mixing(spark, docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(awkward())
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter(r["size"] for r in got) == Counter(size(r[1]) for r in awkward())
    by = defaultdict(list)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        by[r.source].append(r)
    for rows in by.values():
        assert sum(r.taken for r in rows) == round(rows[0].target) and rows[0].source_size == sum(r["size"] for r in rows)
    names = sorted((s for s in by if s is not None)) + [None]
    weight, sizes = dict(zip(names, (3, 1, 2), strict=True)), {s: by[s][0].source_size for s in names}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        level = {s: rest * weight[s] / sum(weight[x] for x in names if x not in fixed) for s in names if s not in fixed}
        over = {s: 2.0 * sizes[s] for s, v in level.items() if v > 2 * sizes[s]}
        if not over:
            break
        fixed |= over
    assert {s: round(v, 6) for s, v in (fixed | level).items()} == {s: round(by[s][0].target, 6) for s in names}
    again = {(r.doc_id, r.taken, r.position) for r in mixing.mix(docs.repartition(2)).collect()}
    assert again == {(r.doc_id, r.taken, r.position) for r in got}
    assert mixing.mix(empty).count() == 0
    taken = mixing.take(docs)
    assert taken.columns == docs.columns and mixing.take(empty).count() == 0
    at = [r.position for r in mixing.range_sorted(mixing.mix(docs)).collect() if r.position is not None]
    assert at == sorted(at)


def test_sharding(spark, docs, empty):
    placed = sharding.shard_documents(docs, 3)
    assert sorted(placed.columns) == sorted({*docs.columns, "slot"})
    rows = placed.collect()
    assert len(rows) == len(awkward())
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert sharding.shard_documents(empty, 3).count() == 0
    hot = [(i, "same" * 20 if i % 3 else prose(i, 20)) for i in range(3000)]
    got = sharding.shard_documents(spark.createDataFrame(hot, "doc_id long, text string"), 24).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += len(r.text.encode()) + 8
    assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= 2 * max(len(t) + 8 for _, t in hot)


def test_url_filter(spark):
    urls = [None, "", "nonsense", "http://A.Example.ORG/en/2?x", "https://b.example.org/es/9", "http://example.org/en/17#t", "http://x.com/fr/", "http://x.com/de/1", "http://notorg/", "http://org/", "http://a.org", "http://u.net/" + "q" * 5000]
    urls += [f"http://good{i}.site.org/read/{i}" for i in range(60)] + [f"http://spam{i}.shop.com/de/buy{i}" for i in range(60)] + ["http://good.site.net/read/5", "http://spam.shop.net/de/buy77"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    got = {r.page_id: r for r in url_filter.judge(pages, rules).collect()}
    assert len(got) == len(urls)
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in (3, 4, 5, 6, 7)] == [
        ("a.example.org", "/en/2", "org/", "allow"), ("b.example.org", "/es/9", "example.org/es/", "block"), ("example.org", "/en/17", "example.org/en/1", "block"),
        ("x.com", "/fr/", "com/fr/", "allow"), ("x.com", "/de/1", "com/de/", "block"),
    ]
    assert [(got[i].host, got[i].path, got[i].rule) for i in (0, 1, 2, 8, 9, 10)] == [("", "", None)] * 3 + [("notorg", "/", None), ("org", "/", "org/"), ("a.org", "", None)]
    assert got[len(urls) - 2].verdict == "allow" and got[len(urls) - 1].verdict == "block"
    assert url_filter.judge(pages.where("false"), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, []).collect()} == {"allow"}


def test_url_filter_by_shuffle_equals_broadcast(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://h{i % 5}.{'org' if i % 2 else 'com'}/{'fr' if i % 3 else 'de'}/{i}") for i in range(80)] + [(90 + i, f"http://h.net/fr/{i}") for i in range(9)], "page_id long, url string")
    rules = [("org", "/", "allow"), ("com", "/de/", "block")]
    a = sorted(map(tuple, url_filter.judge(pages, rules).drop("ratio").collect()), key=str)
    monkeypatch.setattr(url_filter, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, url_filter.judge(pages, rules).drop("ratio").collect()), key=str) == a


def test_language_id(spark, docs, empty):
    en = [(i, "the cat and the dog went to the house with a friend " + prose(i, 3), "en") for i in range(60)]
    fr = [(100 + i, "le chat et le chien sont dans la maison avec une amie " + prose(i, 3), "fr") for i in range(60)]
    train = spark.createDataFrame(en + fr + [(0, None, "en"), (1, "x", None)], "doc_id long, text string, lang string")
    model = language_id.fit(train)
    assert model.languages == ["en", "fr"] and 0.05 <= model.temperature <= 20
    ask = spark.createDataFrame([(1, "the dog and the friend"), (2, "le chien et la maison"), (3, None), (4, " 12 !"), (5, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(ask, model).collect()}
    assert [got[i].lang_pred for i in range(1, 6)] == ["en", "fr", "und", "und", "und"]
    assert got[1].score > 0.5 and got[3].score == 0
    kept = language_id.keep_known(docs, model)
    assert kept.columns == docs.columns and kept.where("text is null or text = ''").count() == 0
    none = language_id.fit(empty)
    assert none.languages == [] and {r.lang_pred for r in language_id.identify(ask, none).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0


def test_language_id_counts_all_documents(spark):
    texts = ["ab", "abab", "", "Ab c"]
    df, n = language_id.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = np.zeros(language_id.SIZE, int)
    for t in texts:
        want[np.unique(language_id._buckets([t])[0])] += 1
    assert n == 4 and (df == want).all()


def test_toxicity(spark, docs, empty):
    r = random.Random(1)
    rows = []
    for i in range(600):
        bad = i % 4 == 0
        w = prose(i, r.randint(5, 60)).split()
        if bad:
            w.insert(r.randrange(len(w)), r.choice(["idiot", "moron", "vequta", "vequer"]))
        rows.append((" ".join(w), int(bad), ["en", "fr"][i % 2]))
    model = toxicity.fit(rows)
    ask = spark.createDataFrame([(1, "alpha beta moron gamma"), (2, "alpha beta gamma delta"), (3, None), (4, ""), (5, "so vequon it is")], "doc_id long, text string")
    got = {x.doc_id: x for x in toxicity.score_documents(ask, model).collect()}
    assert got[1].predicted == 1 and got[2].predicted == 0 and got[5].predicted == 1
    assert got[3].score == got[4].score and got[3].predicted == 0
    scored = toxicity.score_documents(docs, model)
    assert scored.count() == len(awkward()) and scored.where("score < 0 or score > 1 or score is null").count() == 0
    labels = spark.createDataFrame([(6, 1), (6, 0), (8, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    assert [(t, y) for t, y, _ in toxicity.labelled_sample(docs, labels)] == [(awkward()[6][1], 1)] * 2 + [(awkward()[8][1], 0)]
    assert toxicity.fit([]).score(np.zeros((0, 3), int), np.array([0, 0])).tolist() == [0.0]
    assert toxicity.score_documents(empty, model).count() == 0
