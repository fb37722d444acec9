from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from attestor.llm import line_dedup


def shuffled_rows(spark):
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_prefix_tokens_are_not_rows_of_the_shuffle(spark):
    texts = [(d, "\n".join(" ".join(f"w{d}x{i}x{k}" for k in range(60)) for i in range(20))) for d in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    before = shuffled_rows(spark)
    assert all(r.removed == [] for r in line_dedup.find_repeated(df).collect())
    assert shuffled_rows(spark) - before < 6 * 200 * 20  # each line has twelve prefix tokens


def dealt(lines, buckets, often):
    """What ``_dealt`` makes of (copy, doc_id, n, prefix tokens), sorted by bucket, in batches of three rows."""
    copy, doc, n, prefix = zip(*lines, strict=True)
    columns = [pa.array(copy, pa.int64()), pa.array(doc, pa.int64()), pa.array(n, pa.int32()), pa.array([np.array(p, np.int64).tobytes() for p in prefix], pa.binary())]
    batch = pa.record_batch(columns, ["copy", "doc_id", "n", "prefix"])
    batches = [batch.slice(i, 50) for i in range(0, batch.num_rows, 50)]
    made = pa.Table.from_batches(line_dedup._dealt(iter(batches), buckets, often)).sort_by("bucket").combine_chunks()
    return made.to_batches(max_chunksize=3)


@pytest.mark.parametrize("often", [1, 3, 200])
def test_candidates_of_dealt_tokens(monkeypatch, often):
    for name, value in {"SMALL": 3, "PIECE": 20, "CHUNK": 100, "ROWS": 7}.items():
        monkeypatch.setattr(line_dedup, name, value)
    r = np.random.default_rng(2)
    token = lambda x: ((3 if x < 3 else 1) << 56) | (x * 977)
    lines, first = [], {}
    for i in range(400):
        copy = 1000 + i % 300  # a hundred copies come again, in another document
        first.setdefault(copy, sorted({token(x) for x in [int(i % 3), *r.integers(3, 250, 3).tolist()]}))
        lines.append((copy, 7 * i % 1009, 10, first[copy]))
    groups = defaultdict(set)
    for copy, _, _, p in lines:
        for x in p:
            groups[x].add(copy)
    pairs, members = set(), set()
    for b in line_dedup._candidates(iter(dealt(lines, 5, often)), 0.0):
        for row in b.to_pylist():
            if row["a"] == row["b"]:
                members.add((row["token"], row["a"]))
                assert row["at"] == (10 << 32) | first[row["a"]].index(row["token"])
            else:
                assert row["a"] < row["b"]
                pairs.add((row["a"], row["b"]))
    for x, copies in groups.items():
        large = {c for t, c in members if t == x}
        if large:
            assert large == copies
            assert any(all((min(c, d), max(c, d)) in pairs for d in copies if d != c) for c in copies) or often < 200 and x >> 56 >= often
        else:
            assert len(copies) <= 3 and all(p in pairs for p in combinations(sorted(copies), 2))
