"""Fill-in-the-middle: a text is cut at two ranks of its units and put together anew around markers.

Units are found in whole texts at once by big integers with a bit for each byte of the UTF-8: ``bytes.translate``
turns the bytes into class masks, shifts and Boolean operations mark where units begin, ``bit_count`` gives
their number, and the bit of a rank is found by halving the mask again and again.  All of it is linear in
the text's bytes, and memory is a few bytes for each of them.

Null texts are empty.  An empty text, or one that holds a marker, stays plain.  Ties do not arise: the cut
depends on the id and the number of units alone, so repeated rows give the same output, and a null id counts
as an empty one.  Other columns stay; one named as the output column is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.llm.words import text_arrays

#: Markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts, how many stay plain and how many of the others begin with the suffix.
PLAIN_SHARE, SPM_SHARE = 10, 20


def class_mask(data: bytes, table: bytes) -> int:
    """Bit i is set where ``table`` maps byte i to ``1``; tables map to ``0`` and ``1`` only."""
    return int(data.translate(table)[::-1], 2) if data else 0


def _table(member: Callable[[int], bool]) -> bytes:
    return bytes(49 if member(b) else 48 for b in range(256))


_LEAD = _table(lambda b: b & 0xC0 != 0x80)
_SPACE = _table(lambda b: b == 32 or 9 <= b <= 13)
_CR, _LF = _table(lambda b: b == 13), _table(lambda b: b == 10)


def _characters(data: bytes) -> int:
    """Code points begin at every byte that continues none; the first byte begins one whatever it is."""
    return class_mask(data, _LEAD) | 1


def _words(data: bytes) -> int:
    """A unit is a run of other bytes than white space with the white space behind it; the first takes what leads."""
    space = class_mask(data, _SPACE)
    begins = (space << 1) & ~space & ((1 << len(data)) - 1)
    if not data[:1].isspace():
        return begins | 1
    return (begins & (begins - 1)) | 1  # white space in front belongs to the first word


def _lines(data: bytes) -> int:
    """Lines end behind LF, CR LF, or a CR alone."""
    lf = class_mask(data, _LF)
    ends = lf | (class_mask(data, _CR) & ~(lf >> 1))
    return (ends << 1) & ((1 << len(data)) - 1) | 1


UNITS = {"characters": _characters, "words": _words, "lines": _lines}


def ranked_bit(mask: int, rank: int) -> int:
    """Place of the set bit that ``rank`` set bits precede, by halving."""
    at, width = 0, mask.bit_length()
    while width > 1:
        half = width >> 1
        low = mask & ((1 << half) - 1)
        n = low.bit_count()
        if rank < n:
            mask, width = low, half
        else:
            mask, rank, at, width = mask >> half, rank - n, at + half, width - half
    return at


def cut(data: bytes, h1: int, h2: int, units: str = "characters") -> tuple[int, int, int, int, int]:
    """(n, units of the prefix, units up to the suffix, and both in bytes)."""
    mask = UNITS[units](data) if data else 0
    n = mask.bit_count()
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    place = lambda k: len(data) if k == n else ranked_bit(mask, k)
    return n, a, b, place(a), place(b)


def assemble(data: bytes, h1: int, h2: int, h3: int, h4: int, units: str = "characters", plain: int = PLAIN_SHARE, spm: int = SPM_SHARE) -> tuple:
    """(output, form, n, units of the prefix, units of the middle); the last two are None where the form is plain."""
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if not data or h3 % 100 >= 100 - plain or p in data or s in data or m in data:
        return data, "plain", UNITS[units](data).bit_count() if data else 0, None, None
    n, a, b, x, y = cut(data, h1, h2, units)
    if h4 % 100 < spm:
        return s + data[y:] + p + data[:x] + m + data[x:y], "spm", n, a, b - a
    return p + data[:x] + s + data[y:] + m + data[x:y], "psm", n, a, b - a


FIELDS = [("output", pa.string()), ("form", pa.string()), ("n", pa.int64()), ("prefix", pa.int64()), ("middle", pa.int64())]


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers of an id: the first digits of a SHA-256, eight at a time."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, seed: int = 1, units: str = "characters", plain: int = PLAIN_SHARE, spm: int = SPM_SHARE, out: str = "fim"
) -> DataFrame:
    """Add ``fim``: struct of output, form (plain, psm or spm), n, prefix and middle (in units; null if plain)."""

    def transform(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, *numbers in batches:
            data, offsets = text_arrays(texts)
            raw, ends = memoryview(data), offsets.tolist()
            rows = [assemble(bytes(raw[ends[i] : ends[i + 1]]), *h, units, plain, spm) for i, h in enumerate(zip(*(x.to_pylist() for x in numbers), strict=True))]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(FIELDS)
            first = pa.array(columns[0], pa.binary()).view(pa.string())  # bytes as they came, valid UTF-8 or not
            yield pa.StructArray.from_arrays([first, *(pa.array(c, t) for c, (_, t) in zip(columns[1:], FIELDS[1:], strict=True))], names=[f for f, _ in FIELDS])

    transform.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    made = F.arrow_udf(transform, "struct<output:string,form:string,n:long,prefix:long,middle:long>")
    return docs.withColumn(out, made(F.col("text"), *draws(F.col("doc_id"), seed)))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of; markers stand once each, as plain is what holds one before."""
    body = F.substring(output, len(PREFIX) + 1, 1 << 30)
    psm = F.concat(
        F.substring_index(body, SUFFIX, 1), F.substring_index(output, MIDDLE, -1), F.substring_index(F.substring_index(output, SUFFIX, -1), MIDDLE, 1)
    )
    spm = F.concat(
        F.substring_index(F.substring_index(output, PREFIX, -1), MIDDLE, 1), F.substring_index(output, MIDDLE, -1), F.substring_index(body, PREFIX, 1)
    )
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
