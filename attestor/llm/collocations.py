"""Phrase collocations: frequent phrases of two to five words, scored by their weakest cut.

1. Every task counts the n-grams of its texts (one to five words, with the language) in a count-min sketch of
   ``DEPTH`` rows whose cells stop at the least count that matters.  Cells that stop there sum to that count
   exactly where the true sums reach it, so one byte a cell is enough.  The sketches are merged block by block,
   and of the sum only one bit a cell is kept: whether it reaches the least count.  These bits, of fixed size,
   are broadcast.
2. A sketch never counts too low, so an n-gram whose cells are not all set is rare.  The second pass counts the
   others exactly: an n-gram is taken if its own bits are set and those of the two n-grams one word shorter in
   it, which are at least as frequent.  Nothing frequent is lost; what is taken in vain is dropped by its count.
   A task adds up what it has counted and sends it in blocks of lists, a block for each shuffle partition.
3. A phrase's parts are at least as frequent as it, so their counts are all there, and scores, cuts and the
   phrases inside longer ones are joins and groupings of the table of counts.

The sketch has 2^26 cells a row whatever the input (128 MB in a task, 16 MB broadcast).  It lets few rare
n-grams pass up to some 10^10 words; beyond that more of them are aggregated for nothing, with the same result.

Null texts are empty, a null language is ``und``.  Repeated rows count as often as they stand.  Ties are
ordered by the phrase's bytes.  Empty tables give no rows; other columns than text and language are not read.
A text longer than a slice is taken in windows, so memory does not follow it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestor.llm import words as W
from attestor.llm.scratch import materialize

LONGEST, LEAST, TOP = 5, 100, 2000
#: Rows of the sketch and, in bits, cells a row.
DEPTH, CELL_BITS = 2, 26
#: Cells that are merged, compressed and sent together.
BLOCK_BITS = 16
#: Bytes of text taken at once, and counts that a task holds.
SLICE, HELD = 1 << 20, 600_000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_PIECE = np.zeros(256, bool)
_PIECE[[*b".,;:!?", *range(10, 14)]] = True
_WORD = _FOLD.copy()
_WORD[0] = 0xFF  # no byte of UTF-8; 0 is for what parts words
_WORD[_PIECE] = 0
_WORD[[9, 32]] = 0


class Slice:
    """Words of some texts, lower-cased, with the piece and the text that each lies in."""

    def __init__(self, raw: np.ndarray, w: W.Words, again: int = 0) -> None:
        self.raw, self.w, self.again = raw, w, again
        self.text = w.text_of()
        marks = np.cumsum(_PIECE[raw])
        self.piece = (marks[w.starts] if len(w.starts) else np.zeros(0, np.int64)) + self.text  # ascending: differs where text or piece does

    def grams(self, m: int) -> np.ndarray:
        """First words of all runs of m words within pieces whose last word was not in the window before."""
        n = len(self.piece) - m + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        fit = self.piece[:n] == self.piece[m - 1 :]
        fit[: max(0, self.again - m + 1)] = False
        return np.flatnonzero(fit)

    def hashes(self, first: np.ndarray, m: int, of_text: np.ndarray) -> np.ndarray:
        return W.mix(W.run_hash(self.w.hashes, first, first + m, m) ^ of_text[self.text[first]])


def slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, Slice]]:
    """(index of the first text, slice) over a text column; a longer text comes in windows."""
    data, offsets = W.text_arrays(column)
    for i, j in W.slices(offsets, most):
        part = data[offsets[i] : offsets[j]]
        if len(part) <= most:
            yield i, Slice(_FOLD[part], W.words(_WORD[part], offsets[i : j + 1] - offsets[i]))
            continue
        lo = 0
        for w, again in W.windows(_WORD[part], most, LONGEST - 1):
            yield i, Slice(_FOLD[part[lo : lo + len(w.data)]], w, again)
            keep = min(LONGEST - 1, len(w.starts))  # the next window begins with these
            lo += int(w.starts[-keep]) if keep else len(w.data)


def _seeds(langs: pa.Array) -> np.ndarray:
    codes = langs.dictionary_encode()
    each = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in codes.dictionary.to_pylist()]
    return np.array(each, np.uint64)[codes.indices.to_numpy()] if len(langs) else np.zeros(0, np.uint64)


def _cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (W.mix(h, row + 1) >> np.uint64(64 - bits)).astype(np.uint32)


def sketch_bits(docs: DataFrame, least: int = LEAST, bits: int = CELL_BITS, most: int = SLICE) -> np.ndarray:
    """The merged sketch of (lang, text): for each row a bit for each cell, set where its sum reaches ``least``."""
    block_bits = min(BLOCK_BITS, bits)
    kind, stop = (np.uint8, min(least, 255)) if least <= 255 else (np.uint32, least)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.zeros(1 << bits, kind) for _ in range(DEPTH)]
        for batch in batches:
            seeds = _seeds(batch.column("lang"))
            for i, s in slices(batch.column("text"), most):
                h = np.concatenate([s.hashes(s.grams(m), m, seeds[i:]) for m in range(1, LONGEST + 1)])
                for d, row in enumerate(rows):
                    cells, n = np.unique(_cells(h, d, bits), return_counts=True)
                    row[cells] = np.minimum(row[cells] + np.minimum(n, stop), stop)
        for d, row in enumerate(rows):
            for b, block in enumerate(row.reshape(-1, 1 << block_bits)):
                if block.any():
                    yield pa.RecordBatch.from_pydict({"row": pa.array([d], pa.int32()), "block": pa.array([b], pa.int32()), "sums": pa.array([zlib.compress(block, 1)])})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, np.zeros(1 << block_bits, np.int64)

        def done() -> pa.RecordBatch:
            packed = np.packbits(sums >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_pydict({"row": pa.array([at[0]], pa.int32()), "block": pa.array([at[1]], pa.int32()), "sums": pa.array([packed])})

        for batch in batches:
            for d, b, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (d, b) != at:
                    if at is not None:
                        yield done()
                    at, sums = (d, b), np.zeros(1 << block_bits, np.int64)
                sums += np.frombuffer(zlib.decompress(packed), kind)
        if at is not None:
            yield done()

    shape = "row int, block int, sums binary"
    parts = docs.mapInArrow(sketch, shape).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "row", "block")
    merged = materialize(parts.sortWithinPartitions("row", "block").mapInArrow(merge, shape), "sketch")
    out = np.zeros((DEPTH, 1 << max(0, bits - 3)), np.uint8)
    for r in merged.collect():  # of a fixed size: a bit a cell
        bytes_ = np.frombuffer(r.sums, np.uint8)
        out[r.row, r.block * len(bytes_) : (r.block + 1) * len(bytes_)] = bytes_
    return out


def _same(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, like: np.ndarray) -> bool:
    """Whether each span of bytes equals that of index ``like``."""
    n = ends - starts
    if not np.array_equal(n, n[like]):
        return False
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return bool(np.array_equal(data[np.repeat(starts, n) + at], data[np.repeat(starts[like], n) + at]))


def _counts(s: Slice, lang: np.ndarray, seeds: np.ndarray, bits: np.ndarray, cell_bits: int) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray]]:
    """(m, language codes, phrases, counts) of the n-grams whose bits are set; words and n-grams are told apart by their bytes."""
    w = s.w
    _, rep, word = np.unique(w.hashes, return_index=True, return_inverse=True)
    exact = _same(w.data, w.starts, w.ends, rep[word])
    raw = s.raw.tobytes()
    spell = pa.array([raw[w.starts[k] : w.ends[k]] for k in rep], pa.binary())
    shorter = np.zeros(0, bool)
    for m in range(1, LONGEST + 1):
        first = s.grams(m)
        h = s.hashes(first, m, seeds)
        fit = np.ones(len(h), bool)
        for d in range(DEPTH):
            c = _cells(h, d, cell_bits)
            fit &= (bits[d][c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
        if m > 1:
            fit &= shorter[first + 1]
            # in a window that goes on, the n-gram one word shorter in front may lie in the window before
            fit &= shorter[first] | (first + m - 1 <= s.again)
        shorter = np.zeros(len(w.starts) + 1, bool)
        shorter[first[fit]] = True
        first, h = first[fit], h[fit]
        if not len(first):
            continue
        _, at, of, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        like = first[at][of]
        if exact and np.array_equal(lang[s.text[first]], lang[s.text[like]]) and all(np.array_equal(word[first + k], word[like + k]) for k in range(m)):
            first = first[at]
            phrase = pc.binary_join_element_wise(*(spell.take(pa.array(word[first + k])) for k in range(m)), b" ")
            yield m, lang[s.text[first]], phrase, n
        else:  # two 64-bit hashes met
            found = Counter((int(lang[s.text[f]]), b" ".join(raw[w.starts[k] : w.ends[k]] for k in range(f, f + m))) for f in first.tolist())
            yield m, np.array([k[0] for k in found]), pa.array([k[1] for k in found], pa.binary()), np.array([*found.values()])


class Held:
    """Counts of a task's slices, put together before they leave it in blocks; beyond a bound they leave it early."""

    NAMES = ["lang", "m", "phrase", "f"]

    def __init__(self, blocks: int, most: int = HELD) -> None:
        self.tables, self.n, self.blocks, self.most = [], 0, blocks, most

    def _together(self) -> pa.Table:
        t = pa.concat_tables(self.tables).group_by(self.NAMES[:3], use_threads=False).aggregate([("f", "sum")])
        return t.rename_columns(self.NAMES)

    def add(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        self.tables.append(table)
        self.n += len(table)
        if self.n > self.most:
            t = self._together()
            self.tables, self.n = [t], len(t)
            if self.n > self.most // 2:
                yield from self.all()

    def all(self) -> Iterator[pa.RecordBatch]:
        if self.tables:
            yield self.packed(self._together())
        self.tables, self.n = [], 0

    def packed(self, t: pa.Table) -> pa.RecordBatch:
        """The counts as lists, one of each for a block; a phrase's block is a matter of its bytes alone."""
        lang, m, phrase, f = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in t.columns)
        data, upto = W.text_arrays(phrase.cast(pa.large_binary()).view(pa.large_string()))
        block = (W.run_hash(data, upto[:-1], upto[1:], 4) % np.uint64(self.blocks)).astype(np.int32)
        order = np.argsort(block, kind="stable")
        first = np.flatnonzero(np.diff(block[order], prepend=-1))
        cuts, at = pa.array(np.append(first, len(order)), pa.int32()), pa.array(order)
        lists = [pa.ListArray.from_arrays(cuts, c.take(at)) for c in (lang.cast(pa.string()), m, phrase.view(pa.string()), f)]
        return pa.RecordBatch.from_arrays([pa.array(block[order][first]), *lists], names=["block", *self.NAMES])


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The exact counts of blocks that come sorted, of those alone that reach ``least``; one block is held at a time."""
    at, parts = None, []

    def done() -> pa.RecordBatch:
        t = pa.concat_tables(parts).group_by(Held.NAMES[:3], use_threads=False).aggregate([("f", "sum")]).rename_columns(Held.NAMES)
        t = t.filter(pc.or_(pc.equal(t["m"], 0), pc.greater_equal(t["f"], least))).combine_chunks()
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in t.columns], names=Held.NAMES)

    for batch in batches:
        for i, b in enumerate(batch.column(0).to_pylist()):
            if b != at and parts:
                yield done()
                parts = []
            at = b
            parts.append(pa.table([c.slice(i, 1).flatten() for c in batch.columns[1:]], names=Held.NAMES))
    if parts:
        yield done()


def phrase_counts(docs: DataFrame, least: int = LEAST, bits: int = CELL_BITS, most: int = SLICE) -> DataFrame:
    """(lang, m, phrase, f): exact counts of all phrases of m words, one to five, that stand ``least`` times; at m = 0, of all words."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(sketch_bits(texts, least, bits, most))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a block each: more for more data

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_words: Counter[str] = Counter()
        held = Held(parts)
        for batch in batches:
            codes = batch.column("lang").dictionary_encode()
            names, lang, seeds = codes.dictionary, codes.indices.to_numpy(), _seeds(batch.column("lang"))
            for i, s in slices(batch.column("text"), most):
                for k, n in zip(*np.unique(lang[i:][s.text[s.again :]], return_counts=True), strict=True):
                    all_words[names[int(k)].as_py()] += int(n)
                for m, l, phrase, n in _counts(s, lang[i:], seeds[i:], shared.value, bits):
                    yield from held.add(pa.table([names.take(pa.array(l)), pa.array(np.full(len(n), m, np.int32)), phrase, pa.array(n.astype(np.int64))], names=Held.NAMES))
            for k in names.to_pylist():
                all_words[k] += 0
        yield from held.all()
        if all_words:
            yield held.packed(pa.table([[*all_words], pa.array([0] * len(all_words), pa.int32()), pa.array([b""] * len(all_words), pa.binary()), pa.array([*all_words.values()], pa.int64())], names=Held.NAMES))

    found = texts.mapInArrow(count, "block int, lang array<string>, m array<int>, phrase array<string>, f array<long>")
    dealt = found.repartition(parts, "block").sortWithinPartitions("block")
    return dealt.mapInArrow(lambda batches: _merged(batches, least), "lang string, m int, phrase string, f long")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, bits: int = CELL_BITS, most: int = SLICE) -> DataFrame:
    """Per language its ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Scores are whole numbers of 1000 a n / (l r), exact up to counts of 10^16.
    """
    counts = materialize(phrase_counts(docs, least, bits, most), "phrases")
    total = counts.where("m = 0").select("lang", F.col("f").alias("n"))  # a row a language
    phrases = counts.where("m > 1").select("lang", "m", "phrase", F.col("f").alias("a"))
    parts = counts.where("m > 0")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - m)")})
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr("(cast(1000 as decimal(5,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(total, "lang").withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # a longer phrase that is as frequent holds, between, one of one word more that is as well
    inner = F.expr("array(substring_index(phrase, ' ', m - 1), substring_index(phrase, ' ', 1 - m))")
    inside = phrases.where("m > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("within")).groupBy("lang", "phrase").agg(F.max("within").alias("within"))
    kept = best.join(inside, ["lang", "phrase"], "left").where("within is null or within < a")
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")
