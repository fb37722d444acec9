"""Benchmark decontamination: a broadcast hash set of test windows, scanned over all training texts.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z is lower-cased.  An item's windows are its runs
of ``width`` consecutive words; a shorter item, but not an empty one, is one window.  Every window of
a document is looked up by hash; a hit is verified word by word.  A word inside an occurrence is hit.

Nulls: a null text has no words; items of null id are left out.  Repeated item ids are one item.
Repeated documents are judged one by one.  An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.llm.scratch import materialize
from attestor.llm.words import Words, run_hash, word_slices

#: Most bytes of item texts in one broadcast block; a larger benchmark is scanned block by block.
BLOCK_BYTES = 16 << 20
WIDTH = 13
#: Bytes of item texts that are cut into words at once where windows are made.
BUILD_BYTES = 1 << 20


class WindowSet:
    """The different windows of some items: by length their hashes, sorted, where each stands, and the items that hold it.

    The items' words lie in one byte string, each followed by a zero byte, so a window is a slice of it, named by its
    first word.  With places of 32 bits all takes some five times the bytes of the items, less where windows repeat.
    """

    def __init__(self, items: list[tuple[str, str]], width: int) -> None:
        self.ids = [i for i, _ in items]
        #: By length: hash, first word, and the items as a run of ``refs`` between two of ``upto``.
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        packed, word_at, found, n_words, n_bytes = [], [], {}, 0, 0
        for i, _, w in word_slices(pa.array([t for _, t in items], pa.string()), BUILD_BYTES) if items else ():
            packed.append(_pack(w, 0, len(w.starts)))
            word_at.append((np.cumsum(w.ends - w.starts + 1) - (w.ends - w.starts + 1) + n_bytes).astype(np.uint32))
            counts = np.diff(w.first)
            for size in np.unique(np.minimum(counts, width))[::-1].tolist():
                mine = np.flatnonzero(np.minimum(counts, width) == size) if size else np.zeros(0, int)
                n = counts[mine] - size + 1
                starts = np.repeat(w.first[:-1][mine] - np.cumsum(n) + n, n) + np.arange(n.sum())
                if len(starts):
                    row = (run_hash(w.hashes, starts, starts + size, 2), (starts + n_words).astype(np.uint32), np.repeat(mine + i, n).astype(np.uint32))
                    found.setdefault(size, []).append(row)
            n_words, n_bytes = n_words + len(w.starts), n_bytes + len(packed[-1])
        self.packed = b"".join(packed)
        self.word_at = np.concatenate([*word_at, np.array([n_bytes], np.uint32)])
        for size in [*found]:
            h, first, item = (np.concatenate(x) for x in zip(*found.pop(size), strict=True))
            order = np.lexsort((item, h))
            self.windows[size] = self._distinct(h[order], first[order], item[order], size)

    def _distinct(self, h: np.ndarray, first: np.ndarray, item: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
        """One row for each different window of rows that are sorted by hash, each item of it once."""
        new = np.diff(h, prepend=h[:1] ^ np.uint64(1)) != 0
        lead = first[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]  # the first row of the same hash
        for k in np.flatnonzero(~self._alike(first, lead, size)).tolist():  # two windows of one hash: told apart by the words
            same = [j for j in range(int(np.searchsorted(h, h[k])), int(np.searchsorted(h, h[k], "right"))) if self.at(int(first[j]), size) == self.at(int(first[k]), size)]
            lead[k] = first[same[0]]
        order = np.lexsort((item, lead, h))
        h, lead, item = h[order], lead[order], item[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (lead[1:] != lead[:-1])
        once = fresh.copy()
        once[1:] |= item[1:] != item[:-1]
        upto = np.append(np.flatnonzero(fresh[once]), once.sum()).astype(np.uint32)
        return h[fresh], lead[fresh], upto, item[once]

    def _alike(self, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        """Whether the windows at words ``a`` and ``b`` are equal, pair by pair, in pieces."""
        data, out = np.frombuffer(self.packed, np.uint8), a == b
        todo = np.flatnonzero(~out)
        for k in range(0, len(todo), 4096):
            x, y = a[todo[k : k + 4096]].astype(np.int64), b[todo[k : k + 4096]].astype(np.int64)
            n, m = (self.word_at[v + size].astype(np.int64) - self.word_at[v] for v in (x, y))
            same = n == m
            at = np.arange(n[same].sum()) - np.repeat(np.cumsum(n[same]) - n[same], n[same])
            from_x, from_y = (np.repeat(self.word_at[v[same]].astype(np.int64), n[same]) + at for v in (x, y))
            bad = np.zeros(int(same.sum()), np.int64)
            if len(at):
                bad = np.add.reduceat((data[from_x] != data[from_y]).astype(np.int64), np.cumsum(n[same]) - n[same])
            same[same] = bad == 0
            out[todo[k : k + 4096]] = same
        return out

    def at(self, first: int, size: int) -> bytes:
        """The words of a window, each followed by a zero byte."""
        return self.packed[self.word_at[first] : self.word_at[first + size]]

    def scan(self, column: pa.Array) -> Iterator[tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]]:
        """For each slice: word counts, verified spans of words (by text) and items found (by text)."""
        for i, j, w in word_slices(column):
            counts = np.diff(w.first)
            spans, found = [[] for _ in range(j - i)], [set() for _ in range(j - i)]
            for size, (hashes, lead, upto, item) in self.windows.items():
                n = np.maximum(counts - size + 1, 0)
                first = np.concatenate([[0], np.cumsum(n)])
                starts = np.repeat(w.first[:-1] - first[:-1], n) + np.arange(first[-1])
                h = run_hash(w.hashes, starts, starts + size, 2)
                low = np.searchsorted(hashes, h)
                hits = np.flatnonzero(hashes[np.minimum(low, len(hashes) - 1)] == h)
                text = np.searchsorted(first, hits, "right") - 1
                held: dict[int, set[int]] = {}  # the windows that each text holds
                for x, t in zip(hits.tolist(), text.tolist(), strict=True):
                    s, k = int(starts[x]), int(low[x])
                    got = _pack(w, s, s + size)
                    while k < len(hashes) and hashes[k] == h[x]:
                        if self.at(int(lead[k]), size) == got:
                            spans[t].append((s - int(w.first[t]), s - int(w.first[t]) + size))
                            held.setdefault(t, set()).add(k)
                            break
                        k += 1
                for t, windows in held.items():  # items once a window, however often it occurs
                    each = np.unique(np.concatenate([item[upto[k] : upto[k + 1]] for k in sorted(windows)]))
                    found[t].update(self.ids[x] for x in each.tolist())
            yield counts, spans, found


def _pack(w: Words, a: int, b: int) -> bytes:
    """Words a to b, each followed by a zero byte."""
    n = w.ends[a:b] - w.starts[a:b] + 1
    upto = np.cumsum(n)
    if not len(n):
        return b""
    data = np.append(w.data, np.uint8(0)) if len(w.data) and w.ends[b - 1] >= len(w.data) else w.data
    out = data[np.repeat(w.starts[a:b] - upto + n, n) + np.arange(upto[-1])]
    out[upto - 1] = 0  # also where two texts meet
    return out.tobytes()


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


SPANS = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)
SPANS_DDL = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"


def _scanner(block) -> Callable[[Column], Column]:
    """An Arrow UDF: text -> words, merged spans of hit words, items, for the windows of ``block``."""
    from pyspark.sql.functions import arrow_udf

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            n, spans, items = [], [], []
            for counts, s, f in block.value.scan(column):
                n += counts.tolist()
                spans += [[{"start": a, "end": b} for a, b in _merged(x)] for x in s]
                items += [sorted(x) for x in f]
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(spans, SPANS[1].type), pa.array(items, SPANS[2].type)],
                fields=list(SPANS),
            )

    scan.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(scan, f"struct<{SPANS_DDL.replace(' long', ':long').replace('spans array', 'spans:array').replace('items array', 'items:array')}>")


def item_blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of bounded size, one block on the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), "text").where("id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // most) or 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else items
        yield [(r.id, r.text) for r in part.collect()]


def scan(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add ``hits`` (in place of a column of this name): struct of n_words, spans (merged, in words) and items (sorted ids).

    The benchmark is a stated query set: each block of it is scanned over all rows, without a shuffle.  One
    block is broadcast at a time.  Beyond one block only what is hit is written, by the texts' hashes of 128 bits, and
    joined to the rows in the end; the texts themselves are read once a block and never written.
    """
    sc, found, one = docs.sparkSession.sparkContext, [], None
    key = {"_t1": F.xxhash64("text"), "_t2": F.xxhash64(F.lit(1), "text")}
    for items in item_blocks(benchmark, block_bytes):
        if one is not None:
            found.append(_hits(docs.withColumns(key), one))
        one = _scanner(sc.broadcast(WindowSet(items, width)))
    if not found:
        return docs.withColumn("hits", one(F.col("text")))
    found.append(_hits(docs.withColumns(key), one))
    every = reduce(DataFrame.unionByName, found).groupBy("_t1", "_t2").agg(F.flatten(F.collect_list("spans")).alias("_spans"), F.flatten(F.collect_list("items")).alias("_items"))
    counted = docs.withColumns({**key, "_counted": _scanner(sc.broadcast(WindowSet([], width)))(F.col("text"))})
    joined = counted.join(every.withColumnsRenamed({"_t1": "_u1", "_t2": "_u2"}), (F.col("_t1") == F.col("_u1")) & (F.col("_t2") == F.col("_u2")), "left")
    hits = F.struct(
        F.col("_counted.n_words").alias("n_words"), _union(F.coalesce("_spans", F.array().cast("array<struct<start:int,end:int>>"))).alias("spans"),
        F.array_sort(F.array_distinct(F.coalesce("_items", F.array().cast("array<string>")))).alias("items"),
    )
    return joined.withColumn("hits", hits).drop("_counted", "_spans", "_items", "_t1", "_t2", "_u1", "_u2")


def _hits(docs: DataFrame, scanner: Callable[[Column], Column]) -> DataFrame:
    """(_t1, _t2, spans, items): of each different text that a block hits, written."""
    rows = docs.select("_t1", "_t2", scanner(F.col("text")).alias("_f")).where(F.size("_f.items") > 0)
    return materialize(rows.groupBy("_t1", "_t2").agg(F.max(F.struct("_f.spans", "_f.items")).alias("_f")).select("_t1", "_t2", "_f.spans", "_f.items"), "hits")


def _union(spans: Column) -> Column:
    """Spans merged where they overlap or touch."""
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] <= F.element_at(acc, -1)["end"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )


def n_hit(hits: Column) -> Column:
    """Number of hit words."""
    return F.aggregate(hits["spans"], F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]).cast("long"))


def contaminated(hits: Column, share: int = 20) -> Column:
    """Whether words are hit and they are at least one in ``share``."""
    return (n_hit(hits) > 0) & (share * n_hit(hits) >= hits["n_words"])


def items_digest(hits: Column) -> Column:
    """SHA-256 of the item ids, sorted as strings and comma-joined."""
    return F.sha2(F.array_join(hits["items"], ","), 256)


def remove_documents(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents that are not contaminated, columns as they came."""
    rows = docs.select(F.struct("*").alias("_row"), "text")
    return scan(rows, benchmark, width).where(~contaminated(F.col("hits"))).select("_row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """All documents, each occurrence of a window cut from its text, the rest as it was."""
    scanned = scan(docs.select(F.struct("*").alias("_row"), "text"), benchmark, width)

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            pairs = zip(texts.to_pylist(), spans.to_pylist(), strict=True)
            yield pa.array([_without(t, s) if s else t for t, s in pairs], pa.string())

    cut.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    text = F.arrow_udf(cut, "string")(F.col("text"), F.col("hits.spans"))
    rest = [F.col(f"_row.`{c}`").alias(c) if c != "text" else F.col("_cut").alias("text") for c in docs.columns]
    return scanned.withColumn("_cut", text).select(*rest)


def _without(text: str, spans: list) -> str:
    raw = text.encode()
    for _, _, w in word_slices(pa.array([text]), len(raw) + 1):
        out, at = [], 0
        for s in spans:
            out.append(raw[at : w.starts[s["start"]]])
            at = int(w.ends[s["end"] - 1])
        return (b"".join(out) + raw[at:]).decode()
    return text
