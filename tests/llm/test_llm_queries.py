"""The registered queries themselves: SQL in DuckDB, contract columns, groups, and the pipeline, on small tables with planted cases."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from attestor.llm import queries, sharding, toxicity, words

BENCH = " ".join(f"item{i} word" for i in range(20))


def prose(seed, n):
    r = np.random.default_rng(seed)
    return " ".join(f"{'abcdefghijk'[x]}{y}" for x, y in zip(r.integers(0, 11, n), r.integers(0, 500, n), strict=True))


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("planted"))
    english = "the house of the people and the garden with a friend "
    french = "la maison de la ville et le jardin avec une amie "
    rows = [(i, (english if i % 2 else french) * 3 + prose(i, 60) + "\nShort line.", "en" if i % 2 else "fr", ["s", "t", None][i % 3]) for i in range(60)]
    rows += [(100, rows[7][1], "en", "s"), (101, rows[7][1] + " tail", "en", "s"), (102, rows[9][1] + " " + BENCH, "en", "t"), (103, None, None, None), (104, "", "fr", "s"), (105, "12 !", "en", "s")]
    rows = [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(1, BENCH), (2, None), (3, "only here")], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out, rows


def test_sql_queries(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{sf[0]}/{name}.parquet/*.parquet'")
    for name, sql in queries.oracle_sql().items():
        df, cur = queries.queries()[name](spark, sf[0]), con.execute(sql)
        columns = [d[0] for d in cur.description]
        assert sorted(tuple(r) for r in df.select(*columns).collect()) == sorted(cur.fetchall()), name


def test_language_and_sharding_columns(spark, sf):
    texts = {r[0]: r[1] for r in sf[1]}
    got = {r.doc_id: r for r in queries.op3_language_id(spark, sf[0]).collect()}
    assert set(got) == set(texts) and all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 for d, r in got.items())
    assert [got[d].lang_pred for d in (103, 104, 105)] == ["und"] * 3 and all(got[i].lang_pred == ("en" if i % 2 else "fr") for i in range(60))
    rows = queries.op8_sharding(spark, sf[0]).collect()
    assert {r.doc_id for r in rows} == set(texts) and all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 24 for r in rows)
    assert all(r["size"] == len((texts[r.doc_id] or "").encode()) + 8 and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_groups_of_a_fifth_of_a_shard_stay_whole(spark):
    rows = [(g * 100 + i, f"{hashlib.sha256(str(g).encode()).hexdigest()}" + "x" * 128) for g in range(60) for i in range(40)]
    rows += [(10_000 + i, hashlib.sha256(f"o{i}".encode()).hexdigest() * 3) for i in range(9600)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 24).collect()
    shards, sizes = defaultdict(set), Counter()
    for r in got:
        sizes[r.shard] += len(r.text) + 8
        if r.doc_id < 10_000:
            shards[r.text].add(r.shard)
    assert len(shards) == 60 and all(len(x) == 1 for x in shards.values())
    assert len(sizes) == 24 and max(sizes.values()) < 1.3 * sum(sizes.values()) / 24


def test_pipeline(spark, sf):
    out = corpus_pipeline.run(spark, sf[0])
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"}
    ids = Counter(r.doc_id for r in out.collect())
    assert not set(ids) & {100, 101, 102, 103, 104, 105} and set(ids) <= set(range(60)) and max(ids.values()) <= 2
    assert len(ids) > 40  # the mix takes one and a half times all words


def test_long_texts_score_as_in_one_piece():
    r = np.random.default_rng(2)
    rows = [(prose(i, 30) + (" moron" if i % 3 == 0 else ""), int(i % 3 == 0), "en") for i in range(240)]
    model = toxicity.fit(rows, epochs=2)
    for text in (prose(7, 400) + " moron so " + prose(8, 300), prose(9, 500), "a" * 700 + " b", "", " " * 90):
        data = words.folded(np.frombuffer(text.encode(), np.uint8))
        w = words.words(data, np.array([0, len(data)]))
        for most in (40, 333, int(r.integers(50, 900))):
            assert model.score_long(data, most) == pytest.approx(float(model.score(toxicity.features(w), w.first)[0]), abs=1e-5)
