"""Near-duplicate documents: a chosen-path join on word shingles, verified exactly.

A document is the set of its runs of five words (a text of fewer words has one run).  Texts of the
same runs in the same order are one class of copies and join once.

Chosen path: each run of the join grows a tree whose nodes hold sets.  A node samples tokens - here
the coordinates of a min-hash sketch, so that two sets share a sampled token with a chance equal to
their Jaccard similarity - and its sets go to the child of each sampled token that they hold.  The
chance of a token makes two sets at the threshold share ``WIDTH`` of them on average: more than one, so
that they seldom part however deep the tree.  A node of at most ``SMALL`` sets is compared by brute force.
In a larger one, which near copies never leave, all sets are compared with its first; those nearly equal
to it are settled.  The sets near the first are candidates with it, so only the far ones need be told
from the rest: where they are few, they are compared with all of it in blocks; else the unsettled sets
descend.  Trees end where the large nodes take no more rows in blocks than the root has; large nodes of the last level are compared by brute force in blocks.  Runs are
repeated until the target recall, a parameter: ``miss_rate`` is the chance that a pair at the threshold
meets in no node of the last level, with the fixed root seeds here and over all levels, or that its
sketches differ too much to be compared.  This is the worst case, where all nodes of the pair are large
and it is in none of them found through the first.

Sketches only gather candidate groups; those of several blocks are first parted by their sketches.
Within a group all pairs of different texts are verified on their exact shingle sets, in blocks that are
spread over tasks; pairs are counted, not written.

Results, per document: ``rep_id``, the least doc_id of the texts with the same words; ``class_id``, the
least doc_id of the connected component; ``n_links``, the number of other documents at the threshold or
above (copies included).  A text without words, or null, is alone: its class is its own doc_id.
Repeated rows of a doc_id count as copies.  Rows of null doc_id get a null class and no links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestor.llm.components import components
from attestor.llm.groups import groups
from attestor.llm.scratch import materialize
from attestor.llm.words import mix, run_hash, shingle_hashes, word_slices

WORDS, SIMILARITY = 5, 0.8
COORDINATES = 64
#: Target recall of pairs at the threshold, in the worst case.
RECALL = 0.99999
#: Runs that are tried to reach it, at most.
MOST_RUNS = 100
LEVELS = 8
#: Sampled tokens that two sets at the threshold share in a node, on average.
WIDTH = 1.5
#: Sets of a node, or of one side of a block, that are compared by brute force.
SMALL = 128
#: Sets in one side of a block when nodes larger than that are compared: a node of fewer is one task's, without copies of its rows.
WIDE = 1024
#: Sets far from a large node's first up to which they are compared with all others of it.
FAR = 256
#: Sets of a node all of whose candidate pairs are given as they are.
FEW = 16
#: Estimated similarity from which two sets become candidates: four deviations below 0.8.
CANDIDATE = 0.55
#: Estimated similarity from which a set is settled by the first of its node, and that from which it
#: becomes a candidate with it.  Distances of sketches add up, so a set that is a candidate with a settled
#: one is a candidate with the first too.
SETTLED = 0.84
WITH_FIRST = CANDIDATE + SETTLED - 1
#: Texts, and words of texts, in one side of a block of exact comparisons, on average at most.
BLOCK, BLOCK_WORDS = 128, 400_000
#: Members of candidate groups up to which their list is broadcast to the scan of texts.
BROADCAST_MEMBERS = 500_000

SKETCH = "doc_id long, copy long, n long, sketch binary, brief binary"


def _sketches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for i, j, w in word_slices(batch.column(1), 1 << 20):
            shingles, first = shingle_hashes(w, k)
            some = np.diff(first) > 0
            # least image of the shingles under each coordinate's permutation
            low = (shingles >> np.uint64(32)).astype(np.uint32)
            out = np.zeros((j - i, COORDINATES), np.uint32)
            if some.any():
                at = first[:-1][some]
                for c in range(COORDINATES):
                    a = np.uint32((0x9E3779B1 * (2 * c + 1)) & 0xFFFFFFFF | 1)
                    h = (low ^ np.uint32((0x85EBCA6B * (c + 1)) & 0xFFFFFFFF)) * a
                    h ^= h >> np.uint32(15)
                    h *= np.uint32(0x2C1B3C6D)
                    out[some, c] = np.minimum.reduceat(h, at)
            copy = run_hash(w.hashes, w.first[:-1], w.first[1:], 3).view(np.int64)
            n = np.diff(w.first)
            rows = [pa.array([x.tobytes() if s else None for x, s in zip(a, some, strict=True)], pa.binary()) for a in (out, out.astype(np.uint16))]
            yield pa.record_batch([ids.slice(i, j - i).cast(pa.int64()), pa.array(copy), pa.array(n.astype(np.int64)), *rows], ["doc_id", "copy", "n", "sketch", "brief"])


def sketches(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, copy, n, sketch, brief): a hash of the words, their number, the min-hash sketch and its lower half.

    Tokens are taken from whole coordinates; the lower halves suffice to estimate similarities.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda b: _sketches(b, k), SKETCH)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Whole groups from batches that are sorted by ``key``."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.table(batch)
        v = t[key].to_numpy()
        cut = np.concatenate([[0], np.flatnonzero(v[1:] != v[:-1]) + 1, [len(v)]])
        if held and held[0][key][0].as_py() != v[0]:
            yield pa.concat_tables(held)
            held = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if held:
                held.append(t.slice(a, b - a))
                if b < len(v):
                    yield pa.concat_tables(held)
                    held = []
            elif b < len(v):
                yield t.slice(a, b - a)
            else:
                held = [t.slice(a, b - a)]
    if held:
        yield pa.concat_tables(held)


def _matrix(column, kind: type = np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(column if isinstance(column, np.ndarray) else column.to_pylist()), kind).reshape(len(column), COORDINATES)


def _chance(similarity: float, width: float) -> float:
    """The chance that a node samples a token."""
    return min(1.0, width / (similarity * COORDINATES))


def _children(sketch: np.ndarray, path: np.ndarray, similarity: float, width: float = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) of every sampled token that a row holds; the sample depends on the path alone."""
    chance = _chance(similarity, width)
    rows, paths = [], []
    for c in range(COORDINATES):
        draw = mix(path, 100 + c)
        hit = np.flatnonzero((draw >> np.uint64(11)) < np.uint64(int(chance * (1 << 53))))
        rows.append(hit)
        paths.append(mix(draw[hit] ^ (sketch[hit, c].astype(np.uint64) << np.uint64(20)), 7))
    return np.concatenate(rows), np.concatenate(paths)


def _root(run: int) -> np.uint64:
    return mix(np.array([run], np.uint64), 5)[0]


@cache
def miss_rate(runs: int, similarity: float = SIMILARITY, levels: int = LEVELS, width: float = WIDTH) -> float:
    """The chance to miss a pair at the threshold whose nodes are all large, over all levels.

    The coordinates that the two sketches share are drawn once: a pair that shares few does so in every
    run and node.
    """
    chance = _chance(similarity, width)
    sampled = np.zeros(COORDINATES, int)  # how many root tokens have each coordinate
    for r in range(runs):
        draws = np.array([mix(np.array([_root(r)]), 100 + c)[0] for c in range(COORDINATES)])
        sampled += (draws >> np.uint64(11)) < np.uint64(int(chance * (1 << 53)))
    least = ceil(CANDIDATE * COORDINATES)
    missed = sum(comb(COORDINATES, k) * similarity**k * (1 - similarity) ** (COORDINATES - k) for k in range(least))
    for k in range(least, COORDINATES + 1):
        apart = 0.0  # chance that two sets of one root node with k shared coordinates part before the last level
        for _ in range(levels - 1):
            apart = (1 - chance * (1 - apart)) ** k
        by_shared = np.ones(1)  # coefficient i: i coordinates shared and the pair apart below all of them
        for m in sampled:
            by_shared = np.convolve(by_shared, [1 - similarity, similarity * apart**m])
        missed += by_shared[k]
    return float(missed)


@cache
def runs_for(recall: float, similarity: float = SIMILARITY, levels: int = LEVELS, width: float = WIDTH) -> int:
    """The least number of runs that reaches the recall."""
    for runs in range(1, MOST_RUNS + 1):
        if miss_rate(runs, similarity, levels, width) <= 1 - recall:
            return runs
    raise ValueError(f"a recall of {recall} at similarity {similarity} is out of reach of sketches of {COORDINATES} coordinates")


def _start(batches: Iterator[pa.RecordBatch], runs: int, similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketch, ids = _matrix(batch["sketch"]), batch["id"].to_numpy()
        for r in range(runs):
            row, path = _children(sketch, np.full(len(ids), _root(r)), similarity)
            yield pa.record_batch([pa.array(ids[row]), pa.array(path.view(np.int64))], ["id", "path"])


def _descend(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, path = _children(_matrix(batch["sketch"]), batch["path"].to_numpy().view(np.uint64), similarity)
        yield pa.record_batch([pa.array(batch["id"].to_numpy()[row]), pa.array(path.view(np.int64))], ["id", "path"])


def _alike(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Brute force in nodes (part, id, brief): edges that join sets which are alike, directly or through others."""
    for (_, ids, brief), cut in groups(batches):
        size = np.diff(cut)
        if not len(size):
            continue
        m, group, edges = _matrix(brief, np.uint16), np.repeat(np.arange(len(size)), size), []
        few = size[group] <= FEW
        for step in range(1, int(min(size.max(), FEW))):  # pairs that lie so many rows apart in one node
            x = np.flatnonzero((group[step:] == group[:-step]) & few[step:])
            x = x[(m[x] == m[x + step]).mean(1) >= least]
            edges.append((ids[x + step], ids[x]))
        for g in np.flatnonzero(size > FEW):  # each set with the least set that it is alike to, directly or not
            own, node = ids[cut[g] : cut[g + 1]], m[cut[g] : cut[g + 1]]
            alike = np.stack([(node == s).mean(1) for s in node]) >= least
            label = np.arange(len(own))
            while True:
                new = np.where(alike, label[None, :], len(own)).min(1)
                if (new == label).all():
                    break
                label = new
            edges.append((own, own[label]))
        a, b = (np.concatenate(x) for x in zip(*edges, strict=True))
        yield pa.record_batch([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])


def _compared(nodes: DataFrame) -> DataFrame:
    """(a, b) from nodes (node, blocks, id, brief), compared whole or, if of several blocks, in pairs of blocks."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mine = F.pmod(F.xxhash64(F.lit(4), "id"), F.col("blocks"))
    dealt = nodes.withColumn("_mine", mine).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    part = F.when(F.col("blocks") == 1, F.col("node")).otherwise(F.xxhash64("node", F.least("_mine", "_other"), F.greatest("_mine", "_other")))
    dealt = dealt.select(part.alias("part"), "id", "brief").repartition(parts, "part").sortWithinPartitions("part", "id")
    return dealt.mapInArrow(lambda b: _alike(b, CANDIDATE), "a long, b long")


def _with_far(nodes: DataFrame) -> DataFrame:
    """(a, b) from nodes (node, blocks, far, id, brief): each block of a node's near sets with all its far ones."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.pmod(F.xxhash64(F.lit(4), "id"), F.col("blocks"))
    there = F.when(F.col("far"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(own))
    dealt = nodes.withColumn("_block", F.explode(there)).select(F.xxhash64(F.lit(6), "node", "_block").alias("part"), "id", "brief")
    dealt = dealt.repartition(parts, "part").sortWithinPartitions("part", "id")
    return dealt.mapInArrow(lambda b: _alike(b, CANDIDATE), "a long, b long")


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similarity of each row's sketch to its node's first."""
    for batch in batches:
        same = (_matrix(batch["brief"], np.uint16) == _matrix(batch["first_brief"], np.uint16)).mean(1) if batch.num_rows else np.zeros(0)
        yield pa.record_batch([batch["id"], batch["path"], batch["first"], pa.array(same, pa.float64())], ["id", "path", "first", "same"])


def candidate_edges(reps: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, levels: int = LEVELS) -> DataFrame:
    """(a, b): edges that join sets which may be similar into candidate groups; ``reps`` is (id, sketch, brief)."""
    runs = runs_for(recall, similarity, levels)
    members = reps.select("id", "sketch").mapInArrow(lambda b: _start(b, runs, similarity), "id long, path long")
    found: list[DataFrame] = []
    whole = 0
    briefs = reps.select("id", "brief")
    for level in range(levels):
        members = materialize(members, f"paths-{level}")
        sizes = members.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("first")).where("size > 1")
        held_rows = members.count()
        sizes = materialize(sizes, f"nodes-{level}", held_rows)
        # brute force in blocks ends the trees as soon as it takes no more rows than the root did
        whole = whole if level else held_rows
        rows = sizes.where(F.col("size") > SMALL).agg(F.sum(F.col("size") * F.ceil(F.col("size") / SMALL))).first()[0] or 0
        last = level == levels - 1 or rows <= whole
        brute = sizes.where(F.lit(True) if last else F.col("size") <= SMALL)
        brute = brute.select("path", F.ceil(F.col("size") / WIDE).alias("blocks"))
        held = members.join(brute, "path").join(briefs, "id").select(F.col("path").alias("node"), "blocks", "id", "brief")
        found.append(materialize(_compared(held), f"alike-{level}"))
        if last:
            break
        large = sizes.where(F.col("size") > SMALL)
        firsts = large.join(briefs.select(F.col("id").alias("first"), F.col("brief").alias("first_brief")), "first").select("path", "first", "first_brief")
        there = members.join(large.select("path"), "path").join(briefs, "id").select("id", "path", "brief")
        same = there.join(firsts, "path").mapInArrow(_estimate, "id long, path long, first long, same double")
        same = materialize(same, f"firsts-{level}", held_rows)
        found.append(same.where((F.col("id") != F.col("first")) & (F.col("same") >= WITH_FIRST)).select(F.col("id").alias("a"), F.col("first").alias("b")))
        # sets that are candidates with the first are in one group with it: only the far ones need to be told from them
        counts = same.groupBy("path").agg(F.count_if(F.col("same") < WITH_FIRST).alias("n_far"), F.ceil(F.count(F.lit(1)) / SMALL).alias("blocks"))
        counts = materialize(counts.where("n_far > 0"), f"far-{level}", held_rows // SMALL)
        open_ = same.where((F.col("same") < SETTLED) & (F.col("id") != F.col("first")))
        ending = open_.join(counts.where(F.col("n_far") <= FAR), "path").join(briefs, "id")
        ending = ending.select(F.col("path").alias("node"), "blocks", (F.col("same") < WITH_FIRST).alias("far"), "id", "brief")
        found.append(materialize(_with_far(ending), f"far-edges-{level}"))
        rest = open_.join(counts.where(F.col("n_far") > FAR).select("path"), "path", "left_semi")
        members = rest.select("id", "path").join(reps.select("id", "sketch"), "id").mapInArrow(lambda b: _descend(b, similarity), "id long, path long")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    # the same groups by fewer edges: each set with its least partner, and that one with the others
    star = out.groupBy("a").agg(F.collect_set("b").alias("_bs"))  # bounded by the nodes that hold a set
    star = star.withColumn("b", F.least("a", F.array_min("_bs")))
    return star.select(F.explode(F.concat(F.array("a"), "_bs")).alias("a"), "b").where("a <> b").distinct()


def _with_blocks(member: DataFrame) -> DataFrame:
    """Members of groups (id, label, n and more) with the number of blocks of their group."""
    size = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_WORDS)
    return member.join(member.groupBy("label").agg(F.ceil(size).cast("long").alias("blocks")), "label")


def candidate_groups(reps: DataFrame, copies: DataFrame, similarity: float, recall: float) -> DataFrame:
    """Members of candidate groups: (id, grp, rep_id, copies, blocks)."""
    edges = candidate_edges(reps, similarity, recall)
    edges = materialize(edges, "candidates", copies.count())
    found = materialize(components(edges, edges.count()).withColumnRenamed("node", "id"), "groups")
    member = materialize(_with_blocks(found.join(copies, "id")), "members", found.count())
    wide = member.where("blocks > 1")
    if wide.limit(1).count():  # edges to a first are wider than candidates: part such groups by all their sketches
        nodes = wide.select(F.col("label").alias("node"), F.ceil(F.col("blocks") * BLOCK / WIDE).alias("blocks"), "id").join(reps.select("id", "brief"), "id")
        parted = components(_compared(nodes)).withColumnRenamed("node", "id").join(copies, "id")
        member = materialize(member.where("blocks = 1").unionByName(_with_blocks(parted)), "parted", member.count())
    return member.withColumnRenamed("label", "grp")


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The exact shingle set of each text, once for every block pair that it belongs to."""
    for batch in batches:
        meta = {c: batch[c].to_numpy() for c in ("id", "grp", "copies", "block", "blocks")}
        for i, j, w in word_slices(batch["text"], 1 << 20):
            shingles, first = shingle_hashes(w, k)
            copy = run_hash(w.hashes, w.first[:-1], w.first[1:], 3).view(np.int64)
            rows: dict[str, list] = {c: [] for c in ("part", "block", "id", "copies", "shingles", "alone")}
            for x in (np.flatnonzero(copy == meta["id"][i:j]) + i).tolist():  # a doc_id may stand for several texts
                s = np.unique(shingles[first[x - i] : first[x - i + 1]]).tobytes()
                mine, n = int(meta["block"][x]), int(meta["blocks"][x])
                for other in range(n):
                    a, b = min(mine, other), max(mine, other)
                    key = mix(np.array([meta["grp"][x]], np.int64).view(np.uint64) ^ np.uint64((a << 40) ^ (b << 16)), 9)
                    for c, v in zip(rows, (int(key.view(np.int64)[0]), mine, int(meta["id"][x]), int(meta["copies"][x]), s, n == 1), strict=True):
                        rows[c].append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], list(rows))


def _links(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Exact Jaccard between the two blocks of a part (or within its one): copies linked to, least linked id."""
    for t in _groups(batches, "part"):
        ids, at = np.unique(t["id"].to_numpy(), return_index=True)  # repeated rows are one text
        copies, block = t["copies"].to_numpy()[at], t["block"].to_numpy()[at]
        sets = [np.frombuffer(x, np.uint64) for x in t["shingles"].take(pa.array(at)).to_pylist()]
        size = np.array([len(s) for s in sets])
        two = block.min() != block.max()
        left = np.flatnonzero(block == block.min())
        right = np.flatnonzero(block == block.max()) if two else left
        # shingle by text as lists of texts, for shingles that more than one text holds
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        _, code, many = np.unique(flat, return_inverse=True, return_counts=True)
        keep = many[code] > 1
        code, owner = np.unique(code[keep], return_inverse=True)[1], owner[keep]
        n_code = int(code.max()) + 1 if len(code) else 0
        common = np.zeros((len(left), len(right)), np.float32)
        pos = np.full(len(sets), -1)
        pos[left] = np.arange(len(left))
        pos_r = np.full(len(sets), -1)
        pos_r[right] = np.arange(len(right))
        step = max(1, (8 << 20) // max(len(sets), 1))  # bounds the dense slices
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        for lo in range(0, n_code, step):
            a, b = np.searchsorted(code, [lo, lo + step])
            m = np.zeros((len(sets), min(step, n_code - lo)), np.float32)
            m[owner[a:b], code[a:b] - lo] = 1
            common += m[left] @ m[right].T
        total = size[left][:, None] + size[right][None, :] - common
        linked = common >= similarity * total - 1e-6
        if not two:
            np.fill_diagonal(linked, False)
        far = np.iinfo(np.int64).max
        links = np.zeros(len(sets), np.int64)
        links[left] += linked @ copies[right]
        least = np.full(len(sets), far)
        least[left] = np.where(linked, ids[right][None, :], far).min(1)
        if two:
            links[right] += linked.T @ copies[left]
            least[right] = np.where(linked.T, ids[left][None, :], far).min(1)
        label = _labels(linked, left, right, ids)
        some = np.flatnonzero(links > 0)
        alone = pa.array(np.full(len(some), bool(t["alone"][0].as_py())))
        yield pa.record_batch([pa.array(ids[some]), pa.array(links[some]), pa.array(label[some]), alone], ["id", "links", "label", "alone"])


def _labels(linked: np.ndarray, left: np.ndarray, right: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Least id that each text is connected to within the part."""
    label = ids.copy()
    far = np.iinfo(np.int64).max
    while True:
        new = label.copy()
        new[left] = np.minimum(new[left], np.where(linked, label[right][None, :], far).min(1))
        new[right] = np.minimum(new[right], np.where(linked, label[left][:, None], far).min(0))
        if (new == label).all():
            return label
        label = new


def join(docs: DataFrame, k: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(doc_id, rep_id, class_id, n_links) for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(sketches(docs, k), "sketches")
    real = rows.where("n > 0 and doc_id is not null")
    copies = real.groupBy("copy").agg(F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"))
    n_rows = rows.count()
    copies = materialize(copies.withColumnRenamed("copy", "id"), "copies", n_rows)
    found = real.select("doc_id", F.col("copy").alias("id"), "sketch", "brief")
    first = found.join(copies.select("id", F.col("rep_id").alias("doc_id")), ["id", "doc_id"])
    reps = materialize(first.dropDuplicates(["id"]).select("id", "sketch", "brief"), "reps", n_rows)
    member = candidate_groups(reps, copies, similarity, recall)
    block = F.pmod(F.xxhash64(F.lit(3), "id"), F.col("blocks")).alias("block")
    member = member.select("rep_id", "id", "copies", "grp", block, "blocks")
    member = F.broadcast(member) if member.count() <= BROADCAST_MEMBERS else member.hint("merge")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep_id"), "text")
    sets = texts.join(member, "rep_id").mapInArrow(
        lambda b: _sets(b, k), "part long, block long, id long, copies long, shingles binary, alone boolean"
    )
    dealt = sets.repartition(parts, "part").sortWithinPartitions("part", "id")
    links = materialize(dealt.mapInArrow(lambda b: _links(b, similarity), "id long, links long, label long, alone boolean"), "links")
    n_links = links.groupBy("id").agg(F.sum("links").alias("links"))
    # a group of one block knows its components; those of several blocks are put together
    labels = links.where("alone").select("id", "label")
    parted = links.where("not alone").select(F.col("id").alias("a"), F.col("label").alias("b"))
    if parted.limit(1).count():
        labels = labels.unionByName(components(parted, links.count()).select(F.col("node").alias("id"), "label"))

    linked = copies.join(n_links, "id").join(labels, "id")
    classes = linked.groupBy("label").agg(F.min("rep_id").alias("class_id"))
    linked = linked.join(classes, "label").select("id", "class_id", "links")
    of = copies.join(linked, "id", "left").select(
        F.col("id").alias("copy"), "rep_id", F.coalesce("class_id", "rep_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    of = materialize(of, "classes", n_rows)  # so that the join below may split a class of very many copies
    known = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("copy")).alias("copy")
    return rows.select("doc_id", known).join(of, "copy", "left").select(
        "doc_id", F.coalesce("rep_id", "doc_id").alias("rep_id"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, k: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class: of its texts that of least doc_id, and of several texts of this id that of least hash.

    Every text of a doc_id is a document of its own, so none is lost for another one that bears its id.  Rows of
    equal doc_id and text count once, whichever of them stays; documents without words are classes of their own, and
    those of null doc_id all stay.  Columns as they came.
    """
    rows = docs.where("doc_id is not null").select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_key"), "text", F.xxhash64("doc_id", "text").alias("_sid"))
    classes = join(rows.select(F.col("_sid").alias("doc_id"), "text"), k, similarity).select(F.col("doc_id").alias("_sid"), "class_id")
    named = classes.join(rows.select("_sid", "_key").distinct(), "_sid")
    first = named.groupBy("class_id").agg(F.min(F.struct("_key", "_sid")).alias("_first")).select(F.col("_first._sid").alias("_sid"), F.col("_first._key").alias("_key"))
    kept = rows.join(first.distinct(), ["_sid", "_key"], "left_semi")
    one = Window.partitionBy("_sid", "_key").orderBy("_sid")
    kept = kept.withColumn("_nth", F.row_number().over(one)).where("_nth = 1").select("_row.*")
    return kept.unionByName(docs.where("doc_id is null"))
