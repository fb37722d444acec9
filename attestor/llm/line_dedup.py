"""Line dedup: an exact set-similarity join of lines that removes later matches.

A line is the set of its runs of five words (its tokens); a line of fewer words, but not none, has one run
of them all, so it matches lines of the same words alone.  Two lines match if the Jaccard similarity of their sets is at least 0.8.  A line is
removed if any line that stands earlier, by (doc_id, line number), matches it, kept or not.

Tokens are ordered from rare to common by counts over all documents, taken in a table of fixed size: a
count too high by a collision costs speed only, since any common order of tokens is a right one.  Two
matching lines share a token among the first n - ceil(0.8 n) + 1 of each (prefix filter); lengths must
agree within the threshold, and the places of the shared token must leave room for the overlap needed
(positional filter).  What passes is verified on the exact sets.

Lines of equal words join once, through the first of them.  Lines that share a prefix token form a
group.  In groups of at most ``SMALL`` all pairs are candidates.  In larger ones all are compared with
the earliest; those that stay unmatched are compared with the earlier lines of the group alone, in
blocks that spread over tasks: first with the likeliest of each block, then, where that was no match,
with all.  These comparisons pass one more exact filter: tokens flip bits of a 256-bit map, and sets of
sizes a and b whose maps differ in d bits have at most (a + b - d) / 2 tokens in common.

Nulls: a null text is one empty line; a null doc_id is never compared; lines without words stay.
Repeated rows of a doc_id are one document to ``find_repeated``: its equal line numbers are one line.
``remove_repeated`` takes different texts of one doc_id as documents of their own, in the order of their
hashes.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestor.llm.groups import groups
from attestor.llm.scratch import discard, materialize
from attestor.llm.words import Words, folded, mix, run_hash, shingle_hashes, slices, text_arrays, word_slices, words

WORDS, SIMILARITY = 5, 0.8
#: Counters of the table of token frequencies, and the rows that it is summed in.
BITS, CHUNKS = 20, 64
#: Lines that share a prefix token up to which all their pairs are candidates.
SMALL = 16
#: Earlier and unmatched lines of a larger group that are compared at once, on average at most.
BLOCK, ASKED = 256, 2048
#: Rows of a frequent token's group beyond which it is read piece by piece.
PIECE = 1 << 16
#: Tokens that are dealt to buckets at once, rows of a bucket that are sent together, and tokens of texts for which there is a bucket.
CHUNK, ROWS, BUCKET = 1 << 19, 512, 1 << 20
#: Compared lines up to which their list is broadcast to the scan of texts, and further pairs up to which theirs is to that of sets.
BROADCAST_LINES = 500_000
NEWLINE = 10


def line_starts(part: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, number in the text, first byte) of each line of texts that lie back to back, cut at ``upto``."""
    feeds = np.flatnonzero(part == NEWLINE)
    owner = np.concatenate([np.arange(len(upto) - 1), np.searchsorted(upto, feeds, "right") - 1])
    start = np.concatenate([upto[:-1], feeds + 1])
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    return owner, np.arange(len(owner)) - np.searchsorted(owner, np.arange(len(upto) - 1))[owner], start


def line_slices(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, Words]]:
    """(row of each line, its number in the text, words by line) for bounded slices of a batch."""
    data, offsets = text_arrays(text)
    for i, j in slices(offsets, 1 << 20):
        part = data[offsets[i] : offsets[j]]
        owner, number, start = line_starts(part, offsets[i : j + 1] - offsets[i])
        yield owner + i, number, words(folded(part), np.append(start, len(part)))


def chosen_lines(text: pa.Array, wanted: list) -> Iterator[tuple[np.ndarray, np.ndarray, Words]]:
    """(row of each line, its number in the text, words by line) of the wanted lines (lists of numbers by row), for bounded slices of a batch."""
    data, offsets = text_arrays(text)
    for i, j in slices(offsets, 1 << 20):
        part = data[offsets[i] : offsets[j]]
        owner, number, start = line_starts(part, offsets[i : j + 1] - offsets[i])
        length = np.diff(np.append(start, len(part)))
        row = np.repeat(np.arange(j - i), [len(x) for x in wanted[i:j]])
        key = np.unique((row << 40) | np.concatenate([np.zeros(0, np.int64), *[np.asarray(x, np.int64) for x in wanted[i:j]]]))
        at = np.flatnonzero(np.isin((owner << 40) | number, key, assume_unique=True))
        n = length[at]
        upto = np.concatenate([[0], np.cumsum(n)])
        yield owner[at] + i, number[at], words(folded(part[np.repeat(start[at] - upto[:-1], n) + np.arange(upto[-1])]), upto)


def _quarters(n: np.ndarray) -> np.ndarray:
    """log2 in quarter steps."""
    return np.minimum(np.round(4 * np.log2(n + 1.0)), 127).astype(np.uint8)


def token_counts(docs: DataFrame, k: int) -> tuple[np.ndarray, int]:
    """log2 of how often the runs of k words of each cell occur, in quarter steps; the number of runs in all texts."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = lambda c, x: pa.record_batch([pa.array([c], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["chunk", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(1 << BITS, np.int64), [], 0
        for batch in batches:
            for _, _, w in word_slices(batch.column(0), 1 << 20):
                held.append((shingle_hashes(w, k)[0] >> np.uint64(64 - BITS)).astype(np.int32))
                size += len(held[-1])
                if size > 1 << BITS:
                    total += np.bincount(np.concatenate(held), minlength=1 << BITS)
                    held, size = [], 0
        total += np.bincount(np.concatenate([np.zeros(0, np.int32), *held]), minlength=1 << BITS)
        for c, x in enumerate(np.split(total.astype(np.min_scalar_type(total.max())), CHUNKS)):
            yield row(c, x)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, x in zip(batch["chunk"].to_pylist(), batch["n"].to_pylist(), strict=True):
                total[c] = total.get(c, 0) + np.frombuffer(x, f"u{len(x) * CHUNKS >> BITS}").astype(np.int64)
        for c, x in total.items():
            yield row(c, x)

    schema = "chunk int, n binary"
    rows = docs.select("text").mapInArrow(count, schema).repartition(min(parts, CHUNKS), "chunk").mapInArrow(add, schema).collect()
    total = np.zeros(1 << BITS, np.int64)
    for r in rows:  # at most CHUNKS rows
        total[r.chunk * (len(total) // CHUNKS) :][: len(total) // CHUNKS] = np.frombuffer(r.n, np.int64)
    return _quarters(total), int(total.sum())


def _token_sets(w: Words, k: int, rarity: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, token) sorted by line and token, without repeats, and the number by line.

    With ``rarity`` a token's upper bits are its frequency, so that the order of numbers is from rare to common.
    """
    h, first = shingle_hashes(w, k)
    n = np.diff(first)
    token = h.view(np.int64)
    if rarity is not None:
        token = (rarity[(h >> np.uint64(64 - BITS)).astype(np.int64)].astype(np.int64) << 56) | (h >> np.uint64(8)).astype(np.int64)
    line = np.repeat(np.arange(len(n)), n)
    if len(n) <= 1 << 16:  # as lexsort would, in half the time: numbers of 16 bits are sorted by radix
        order = np.argsort(token)
        order = order[np.argsort(line[order].astype(np.uint16), kind="stable")]
    else:
        order = np.lexsort((token, line))
    token, line = token[order], line[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (line[1:] != line[:-1])
    token, line = token[new], line[new]
    return line, token, np.bincount(line, minlength=len(n))


def prefix_length(n: np.ndarray, similarity: float) -> np.ndarray:
    return np.where(n > 0, n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1, 0)


def _bits(token: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each line's map of 256 bits, as four numbers: tokens flip one bit each."""
    at = mix(token.view(np.uint64), 21) >> np.uint64(56)
    bit = np.uint64(1) << (at & np.uint64(63))
    out = np.zeros((len(n), 4), np.uint64)
    some = n > 0
    for x in range(4):
        if some.any():
            out[some, x] = np.bitwise_xor.reduceat(np.where(at >> np.uint64(6) == x, bit, np.uint64(0)), (np.cumsum(n) - n)[some])
    return out


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value a row, of so many of the values each."""
    offsets = (np.concatenate([[0], np.cumsum(counts)]) * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


LINES = "doc_id long, line int, copy long, n int, first boolean, prefix binary"


def _lines(batches: Iterator[pa.RecordBatch], k: int, similarity: float, rarity) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for row, number, w in line_slices(batch.column(1)):
            line, token, n = _token_sets(w, k, rarity.value)
            copy = run_hash(w.hashes, w.first[:-1], w.first[1:], 3).view(np.int64)
            order = np.lexsort((number, copy, row))
            first = np.ones(len(row), bool)
            first[order[1:]] = (copy[order[1:]] != copy[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
            first &= n > 0
            # lines of fewer words meet their like as copies
            p = np.where(first & (np.diff(w.first) >= k), prefix_length(n, similarity), 0)
            place = np.arange(len(token)) - (np.cumsum(n) - n)[line]
            yield pa.record_batch(
                [
                    ids.take(pa.array(row)).cast(pa.int64()), pa.array(number.astype(np.int32)), pa.array(copy, mask=n == 0),
                    pa.array(n.astype(np.int32)), pa.array(first), _binary(token[place < p[line]], p),
                ],
                ["doc_id", "line", "copy", "n", "first", "prefix"],
            )


DEALT = "bucket long, rows binary"


def _dealt(batches: Iterator[pa.RecordBatch], buckets: int, often: int) -> Iterator[pa.RecordBatch]:
    """Prefix tokens by bucket: (token, copy, doc, at) as rows of four numbers, up to ``ROWS`` of a bucket at a time.

    ``at`` is the line's length and the token's place.  A copy comes once for some ``CHUNK`` tokens, with its least document.
    A token of frequency ``often`` or above has a negative bucket of its own.
    """

    def chunk(copy: np.ndarray, doc: np.ndarray, n: np.ndarray, p: np.ndarray, token: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((doc, copy))
        first = np.ones(len(copy), bool)
        first[order[1:]] = copy[order[1:]] != copy[order[:-1]]
        token, copy, doc, n, p = token[np.repeat(first, p)], copy[first], doc[first], n[first].astype(np.int64), p[first]
        line = np.repeat(np.arange(len(p)), p)
        bucket = (mix(token.view(np.uint64), 7) % np.uint64(buckets)).astype(np.int64)
        bucket = np.where(token >> 56 >= often, -1 - token, bucket)
        order = np.argsort(bucket)
        bucket, line = bucket[order], line[order]
        at = (n[line] << 32) | (order - (np.cumsum(p) - p)[line])
        begin = np.searchsorted(bucket, bucket)
        cut = np.flatnonzero((np.arange(len(bucket)) - begin) % ROWS == 0)
        rows = np.stack([token[order], copy[line], doc[line], at], 1)
        return pa.record_batch([pa.array(bucket[cut]), _binary(rows.ravel(), 4 * np.diff(np.append(cut, len(bucket))))], ["bucket", "rows"])

    held, size = [], 0
    for batch in batches:
        raw = batch["prefix"].to_pylist()
        token = np.frombuffer(b"".join(raw), np.int64)
        held.append([*(batch[c].to_numpy() for c in ("copy", "doc_id", "n")), np.array([len(x) // 8 for x in raw], np.int64), token])
        size += len(token)
        if size > CHUNK:
            yield chunk(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, size = [], 0
    if size:
        yield chunk(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, bool]]:
    """The rows of each bucket, and whether these are all; those of one frequent token may come in pieces, each with the earliest of the last."""
    held, size, now, whole = [], 0, None, True
    for batch in batches:
        bucket, rows = batch.column(0).to_numpy(), batch.column(1).cast(pa.large_binary())
        _, offsets, data = rows.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(rows) + 1, rows.offset * 8) // 8
        data = np.frombuffer(data, np.int64, offsets[-1])
        cut = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            if hi > lo and bucket[lo] != now:
                if held:
                    yield np.concatenate(held), whole
                held, size, now, whole = [], 0, bucket[lo], True
            held.append(data[offsets[lo] : offsets[hi]].reshape(-1, 4))
            size += len(held[-1])
            if size > PIECE and now < 0:
                rows, whole = np.concatenate(held), False
                yield rows, whole
                held, size = [rows[np.lexsort((rows[:, 1], rows[:, 2]))[:1]]], 1
    if held:
        yield np.concatenate(held), whole


def _overlap(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Tokens that sets of sizes a and b must have in common."""
    return np.ceil(similarity / (1 + similarity) * (a + b) - 1e-9)


def _may_match(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Length and positional filter for sets of sizes a and b with a common token at places i and j."""
    room = np.minimum(i, j) + 1 + np.minimum(a - i, b - j) - 1
    return (np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-9) & (room >= _overlap(a, b, similarity))


PAIRS = "a long, b long, token long, at long"


def _pair_batch(*cols: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.int64()) for c in cols], ["a", "b", "token", "at"])


def _candidates(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Pairs (a < b) of small groups; of larger ones pairs with the earliest, and each member (a = b, with token and at)."""
    for rows, whole in _buckets(batches):
        if whole:  # most tokens stand alone
            order = np.argsort(rows[:, 0])
            same = np.diff(rows[order, 0]) == 0
            rows = rows[order[np.append(same, False) | np.append(False, same)]]
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        rows = rows[np.append(True, np.any(rows[1:, :2] != rows[:-1, :2], axis=1))[: len(rows)]]
        token, copy, doc, at = rows[np.lexsort((rows[:, 1], rows[:, 2], rows[:, 0]))].T.copy()
        cut = np.append(np.flatnonzero(np.append(True, token[1:] != token[:-1])[: len(token)]), len(token))
        size = np.diff(cut)
        if not len(size):
            continue
        n, place = at >> 32, at & 0xFFFFFFFF
        group = np.repeat(np.arange(len(size)), size)
        large = (size[group] > SMALL) | (not whole)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]  # what only copies of one line share makes no pair
        for step in range(1, int(min(size.max(), SMALL))):  # pairs that lie so many rows apart in one small group
            x = np.flatnonzero((group[step:] == group[:-step]) & ~large[step:])
            left.append(x)
            right.append(x + step)
        if large.any():
            x = np.flatnonzero(large)
            pivot = cut[:-1][group[x]]  # rows come in order of documents
            left.append(pivot[pivot != x])
            right.append(x[pivot != x])
        x, y = np.concatenate(left), np.concatenate(right)
        ok = (copy[x] != copy[y]) & _may_match(n[x], place[x], n[y], place[y], similarity)
        a, b = copy[x[ok]], copy[y[ok]]
        zero = np.zeros(len(a), np.int64)
        yield _pair_batch(np.minimum(a, b), np.maximum(a, b), zero, zero)
        yield _pair_batch(copy[large], copy[large], token[large], at[large])


def _earlier(batches: Iterator[pa.RecordBatch], similarity: float, likeliest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of unmatched lines with earlier lines of a block: the likeliest of each alone, or all that may match."""
    for (_, copy, doc, line, at, bits, free), cut in groups(batches):
        n, place = at >> 32, at & 0xFFFFFFFF
        maps = np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), 4)
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            old, new = lo + np.flatnonzero(~free[lo:hi]), lo + np.flatnonzero(free[lo:hi])
            for x in np.array_split(new, max(1, len(new) * len(old) >> 20)):  # bounds the matrices
                x, y = x[:, None], old[None, :]
                before = (doc[y] < doc[x]) | ((doc[y] == doc[x]) & (line[y] < line[x]))
                most = (n[x] + n[y] - sum(np.bitwise_count(maps[x, c] ^ maps[y, c]).astype(np.int64) for c in range(4))) // 2
                ok = before & (most >= _overlap(n[x], n[y], similarity)) & _may_match(n[x], place[x], n[y], place[y], similarity)
                if likeliest:
                    score = np.where(ok, most / np.maximum(n[x] + n[y] - most, 1), -1.0)
                    best = score.argmax(1) if len(old) else np.zeros(len(x), int)
                    i = np.flatnonzero(ok[np.arange(len(x)), best]) if len(old) else np.zeros(0, int)
                    j = best[i]
                else:
                    i, j = np.nonzero(ok)
                a, b = copy[x[i, 0]], copy[y[0, j]]
                zero = np.zeros(len(a), np.int64)
                yield _pair_batch(np.minimum(a, b), np.maximum(a, b), zero, zero)


SETS = "copy long, doc_id long, line int, shingles array<long>, bits binary"


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(copy, shingles, bits) of the wanted lines of each text, and where they stand."""
    for batch in batches:
        for rows, number, w in chosen_lines(batch["text"], batch["lines"].to_pylist()):
            _, token, n = _token_sets(w, k, None)
            copy = run_hash(w.hashes, w.first[:-1], w.first[1:], 3).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            maps = _binary(_bits(token, n).ravel(), np.full(len(n), 4))
            columns = [pa.array(copy), batch["doc_id"].take(pa.array(rows)), pa.array(number.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(token)), maps]
            yield pa.record_batch(columns, ["copy", "doc_id", "line", "shingles", "bits"])


def _matched(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Copies (one column) that an earlier line matches, among candidate pairs (a, b)."""
    side = lambda x: sets.select(*[F.col(c).alias(x if c == "copy" else f"{x}_{c}") for c in ("copy", "shingles", "doc_id", "line")])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("a_shingles", "b_shingles"))
    every = F.size("a_shingles") + F.size("b_shingles") - common
    a_first = F.struct("a_doc_id", "a_line") < F.struct(F.col("b_doc_id").alias("a_doc_id"), F.col("b_line").alias("a_line"))
    return both.where(common >= similarity * every - 1e-9).select(F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("copy")).distinct()


def find_repeated(docs: DataFrame, k: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, n_lines, removed): for each document its number of lines and the sorted numbers (from 0) to remove."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts, total = token_counts(docs, k)
    rarity = spark.sparkContext.broadcast(counts)
    buckets = max(parts, total // BUCKET)
    often = int(_quarters(np.float64(PIECE + 8 * total / (1 << BITS))))  # cells of other tokens alone stay below that
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lines = materialize(source.mapInArrow(lambda b: _lines(b, k, similarity, rarity), LINES), "lines")
    usable = F.col("copy").isNotNull() & F.col("doc_id").isNotNull()
    first = F.min(F.struct("doc_id", "line")).alias("at")
    copies = lines.where(usable & F.col("first")).groupBy("copy").agg(first, F.count(F.lit(1)).alias("rows"))
    copies = materialize(copies.select("copy", "at.doc_id", "at.line", "rows"), "line-copies")

    long = lines.where(usable & F.col("first") & (F.octet_length("prefix") > 0)).select("copy", "doc_id", "n", "prefix")
    dealt = long.mapInArrow(lambda b: _dealt(b, buckets, often), DEALT).repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int")).sortWithinPartitions("bucket")
    found = materialize(dealt.mapInArrow(lambda b: _candidates(b, similarity), PAIRS), "candidates")
    pairs = materialize(found.where("a <> b").select("a", "b").distinct(), "pairs")
    hot = materialize(found.where("a = b").select("token", F.col("a").alias("copy"), "at").distinct(), "members")

    compared = pairs.select(F.col("a").alias("copy")).unionByName(pairs.select(F.col("b").alias("copy"))).unionByName(hot.select("copy")).distinct()
    place = materialize(copies.select("copy", "doc_id", "line").join(compared, "copy"), "compared")
    wanted = place.groupBy("doc_id").agg(F.collect_set("line").alias("lines"))  # bounded by a document's lines
    n = place.count()
    if n <= BROADCAST_LINES:
        wanted = F.broadcast(wanted)
    sets = source.join(wanted, "doc_id").select("doc_id", "text", "lines").mapInArrow(lambda b: _sets(b, k), SETS)
    sets = materialize(sets, "line-sets")
    old = [found, pairs, hot, place, sets]
    if sets.count() > n:  # rows that share a doc_id
        sets = materialize(sets.join(place, ["copy", "doc_id", "line"], "left_semi").dropDuplicates(["copy"]), "line-sets")
        old.append(sets)
    matched = materialize(_matched(pairs, sets, similarity), "matched")

    for likeliest in (True, False):
        free = hot.join(matched, "copy", "left_anti")
        if not free.limit(1).count():
            break
        known = sets.select("copy", "doc_id", "line", "bits")
        member = hot.join(free.select("token", "copy", F.lit(True).alias("free")), ["token", "copy"], "left")
        sizes = member.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"), F.ceil(F.count("free") / ASKED).alias("chunks"))
        member = member.join(sizes.where("chunks > 0"), "token").join(known, "copy")
        mine = lambda n: F.pmod(F.xxhash64(F.lit(5), "copy"), F.col(n))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        row = lambda is_free: [
            F.xxhash64("token", "_block", "_chunk").alias("part"), "copy", "doc_id", "line", "at", "bits", F.lit(is_free).alias("free"),
        ]
        blocks = member.withColumn("_block", mine("blocks")).withColumn("_chunk", every("chunks")).select(*row(False))
        asked = member.where("free").withColumn("_chunk", mine("chunks")).withColumn("_block", every("blocks")).select(*row(True))
        dealt = blocks.unionByName(asked).repartition(parts, "part").sortWithinPartitions("part", "free", "doc_id", "copy")
        more = dealt.mapInArrow(lambda b, only=likeliest: _earlier(b, similarity, only), PAIRS).select("a", "b").distinct()
        more = materialize(more.join(pairs, ["a", "b"], "left_anti"), "more-pairs")
        near = sets
        if more.count() <= BROADCAST_LINES:
            near = sets.join(F.broadcast(more.select(F.explode(F.array("a", "b")).alias("copy")).distinct()), "copy", "left_semi")
        matched = materialize(matched.unionByName(_matched(more, near, similarity)).distinct(), "matched")
        pairs = pairs.unionByName(more)
        old.append(more)

    fate = copies.join(matched.withColumn("hit", F.lit(True)), "copy", "left").where("hit or rows > 1")  # what stands once and unmatched stays
    fate = materialize(fate.select("copy", F.col("doc_id").alias("first_doc"), "hit"), "fates")  # so that the join below may split a line of very many copies
    discard(copies, *old)
    compared = lines.where(usable).select("doc_id", "line", "copy", "first").join(fate, "copy", "left")
    gone = F.coalesce("hit", F.lit(False)) | ~F.col("first") | F.coalesce(F.col("doc_id") != F.col("first_doc"), F.lit(False))
    judged = compared.where(gone).select("doc_id", "line").groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("removed"))
    sizes = lines.groupBy("doc_id").agg((F.max("line") + 1).cast("long").alias("n_lines"))
    return sizes.join(judged, "doc_id", "left").select("doc_id", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def _own_ids(rows: DataFrame) -> DataFrame:
    """Add ``_id``: the doc_id ``_key``, or where a doc_id has several texts (hash ``_hash``), numbers in order of both."""
    texts = rows.where("_key is not null").select("_key", "_hash")
    several = texts.groupBy("_key").agg((F.min("_hash") < F.max("_hash")).alias("several")).where("several").limit(1).count()
    if not several:
        return rows.withColumn("_id", F.col("_key"))
    ids = texts.distinct().orderBy("_key", "_hash").withColumn("_id", F.monotonically_increasing_id())
    return rows.join(materialize(ids, "ids"), ["_key", "_hash"], "left")


def remove_repeated(docs: DataFrame, k: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without their repeated lines; columns as they came."""
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_key"), F.xxhash64("text").alias("_hash"))
    rows = _own_ids(rows)
    found = find_repeated(rows.select(F.col("_id").alias("doc_id"), "_row.text"), k, similarity)
    found = found.where(F.size("removed") > 0).select(F.col("doc_id").alias("_doc"), "removed")

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, removed in batches:
            out = []
            for t, r in zip(texts.to_pylist(), removed.to_pylist(), strict=True):
                gone = set(r or ())
                out.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone) if gone else t)
            yield pa.array(out, pa.string())

    cut.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    joined = rows.join(found, F.col("_id") == F.col("_doc"), "left").withColumn("_text", F.arrow_udf(cut, "string")(F.col("_row.text"), F.col("removed")))
    return joined.select(*[F.col("_text").alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
