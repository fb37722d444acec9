"""Token counts of whole texts, huge ones in overlapping chunks that are spliced where they agree.

A huge text is encoded in chunks that overlap.  Two neighbours are spliced at a position that is a
token boundary in both, and that is proven stable: a visible character stands before it and a plain
space or line feed at it, or an ASCII letter meets an ASCII digit, or a full-width stop or comma meets a
Chinese or Japanese letter.  The byte-level pattern never matches across such a place (a match that
holds visible characters holds white space only as its first character, and of letters, digits and signs
one kind alone, but for an apostrophe and letters), and what follows is matched without a look back, so
both chunks and the whole text have the same boundary there.  A chunk that ends early can differ only in
its last pieces, which lie behind the splice.  If the overlap holds no such position, it is widened; in
the end the chunk takes in the text up to the next one, by steps that double, so that at most some three
times the text is encoded.

The same proof lets ordinary texts be cut at stable places: each piece is encoded once by the library
and remembered while the worker lives.  Texts that do not meet the proof's conditions, and tokenizers
whose pre-tokenizer is not byte-level, are encoded whole.

A null text counts as empty: 0 bytes, 0 tokens.  Repeated rows are counted one by one; an empty table gives
an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts of more code points are encoded in overlapping chunks.
HUGE = 32_768
CHUNK = 16_384
OVERLAP = 256
#: Pieces that a worker remembers; then it starts anew.
REMEMBERED = 400_000
NEVER = -(1 << 40)
#: White space and unseen characters, by any reading, beyond ASCII.
_BLANK = "\u0080-\u00a0\u00ad\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"
STABLE = re.compile(rf"(?<=[!-~])(?=[ \n])|(?<=[^\x00-\x7f{_BLANK}])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[\u3001\u3002\uff0c\uff01\uff1f])(?=[\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff])")


@lru_cache(maxsize=4)
def load(path: str):
    """(encode a text to token end offsets, count tokens of many texts, whether splicing is proven)."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return None, lambda xs: [len(x) for x in sp.encode(xs, num_threads=1)], False
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, pre_tokenizers

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    byte_level = isinstance(tok.pre_tokenizer, pre_tokenizers.ByteLevel) and tok.normalizer is None
    proven = byte_level and tok.pre_tokenizer.use_regex and not tok.pre_tokenizer.add_prefix_space
    proven = proven and all(not (t.lstrip or t.rstrip or re.search(r"\s", t.content)) for t in tok.get_added_tokens_decoder().values())

    def ends(text: str) -> np.ndarray:
        return np.array([b for _, b in tok.encode(text, add_special_tokens=False).offsets], np.int64)

    def counts(texts: list[str]) -> list[int]:
        return [len(e.ids) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    return ends, counts, proven


def _cut(text: str, a: int, b: int, left: np.ndarray, right: np.ndarray) -> int | None:
    """The last stable position in text[a:b] that is a token boundary in both encodings (absolute ends)."""
    both = np.intersect1d(left[(left > a) & (left < b)], right)
    for p in both[::-1].tolist():
        if STABLE.match(text, p):
            return p
    return None


def spliced(text: str, ends: Callable[[str], np.ndarray], chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, from overlapping chunks; equals encoding it whole."""
    total, lo, hi = 0, 0, min(chunk, len(text))
    here = ends(text[lo:hi])
    base = 0  # tokens that end up to here are counted
    while hi < len(text):
        wide, p = overlap, None
        while p is None:
            start = max(base, hi - wide)
            stop = min(len(text), hi + max(chunk, hi - base))
            # what lies behind a splice must be past the start of the next chunk by a stable place
            first = STABLE.search(text, start + 1, hi) if start > base else None
            if first or start <= base:
                ahead = ends(text[start:stop]) + start
                p = _cut(text, first.start(), hi, here, ahead) if first else None
            if p is None and start <= base:
                break
            wide *= 4
        if p is None:  # no stable place since the last splice: take the text in at one go
            here, hi = ahead, stop
            continue
        total += int(np.sum((here > base) & (here <= p)))
        base, here, hi = p, ahead, stop
    return total + int(np.sum(here > base))


class Counter:
    """Counts tokens; remembers pieces."""

    def __init__(self, path: str, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        self.ends, self.counts, self.proven = load(path)
        self.huge, self.chunk, self.overlap = huge, chunk, overlap
        self.known: dict[str, int] = {}  # tokens of " " + piece, or NEVER where the next space is no stable place
        self.heads: dict[str, int] = {}

    def _learn(self, pieces: list[str]) -> None:
        """Count pieces in few library calls: back to back they are a text cut at stable places only."""
        if len(self.known) + len(pieces) > REMEMBERED:
            self.known.clear()
        self.known.update((p, NEVER) for p in pieces if not p or p[-1].isspace())
        pieces = [p for p in pieces if p and not p[-1].isspace()]
        for i in range(0, len(pieces), 2000):
            part = pieces[i : i + 2000]
            stops = np.cumsum([len(p) + 1 for p in part])
            upto = np.searchsorted(self.ends("".join(" " + p for p in part)), stops, "right")
            self.known.update(zip(part, np.diff(upto, prepend=0).tolist(), strict=True))

    def _learn_heads(self, heads: list[str]) -> None:
        if len(self.heads) + len(heads) > REMEMBERED:
            self.heads.clear()
        self.heads.update((h, n if not h or not h[-1].isspace() else NEVER) for h, n in zip(heads, self.counts(heads), strict=True))

    def __call__(self, texts: list[str]) -> list[int]:
        if not self.proven:
            return self.counts(texts)
        out, plain = [0] * len(texts), []
        for i, t in enumerate(texts):
            if len(t) > self.huge:
                out[i] = spliced(t, self.ends, self.chunk, self.overlap)
            else:
                plain.append((i, t.split(" ")))
        self._learn_heads([*{x[0] for _, x in plain} - self.heads.keys()])
        self._learn([*set().union(*(x[1:] for _, x in plain)) - self.known.keys()])
        for i, x in plain:
            try:
                n = self.heads[x[0]] + sum(map(self.known.__getitem__, x[1:]))
            except KeyError:  # forgotten when the memory was emptied
                n = NEVER
            # a text in which white space stands before a space, at its end apart, is encoded whole
            out[i] = n if n >= 0 else self.counts([texts[i]])[0]
        return out


def token_count(text: Column, path: str, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """Number of tokens of ``text`` by the tokenizer file at ``path`` (.json or .model)."""

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(path, huge, chunk, overlap)
        for column in batches:
            texts = column.fill_null("")
            n = []
            for i in range(0, len(texts), 500):
                n += counter(texts.slice(i, 500).to_pylist())
            yield pa.array(n, pa.int64())

    count.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(count, "long")(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit."""
    n = token_count(F.col("text"), path)
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), n.alias("n_tokens")).withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
