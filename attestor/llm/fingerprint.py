"""Merkle fingerprints of documents (DataFrame functions only).

A text is a tree: sections (blocks between blank lines) of paragraphs (lines) of pieces (sentences,
or 40 code points where a sentence runs on).  A piece's digest is the first half of its SHA-256; a
paragraph's digest covers its pieces' digests, a section's its paragraphs', the root all sections'
(SHA-256), each level with a mark of its own.  So equal roots mean equal texts, but for collisions of
128 bits, and where roots differ the first differing branches locate the edit.

The fingerprint is a string: root, then for each section its digest, its paragraphs' digests and the
short labels of their pieces: ``root|section:paragraph=piece.piece,paragraph=...|section:...``.
A null text counts as empty, whose one paragraph has no piece.  Columns that are called like a result are
left out of it; of equal rows one is the next of the other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestor.llm.ranges import in_range, range_count
from attestor.llm.scratch import materialize

#: A piece: up to 40 code points to the end of a sentence, ends of sentence included.
PIECE = r"[^.!?]{1,40}[.!?]*|[.!?]+"
BLANK_LINES = r"(?<=\n)(?=[ \t]*\n)"
#: Hex digits of the digests shown below the root.
LABEL = 8
#: Expected number of sampled ids that give the ranges of ``with_next``.
SAMPLE = 20_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _node(digests: Column, shown: Column, mark: str, sep: str) -> Column:
    """struct<d, s>: the digest over children's digests, and it with the children as shown."""
    return _let(
        F.sha2(F.concat(F.lit(mark), F.array_join(digests, "")), 256),
        lambda d: F.struct(d.alias("d"), F.concat(F.substring(d, 1, LABEL), F.lit(mark), F.array_join(shown, sep)).alias("s")),
    )


def _paragraph(p: Column) -> Column:
    leaves = F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), lambda x: F.left(F.sha2(x, 256), F.lit(32)))
    return _let(leaves, lambda x: _node(x, F.transform(x, lambda y: F.right(y, F.lit(LABEL))), "=", "."))


def _section(s: Column) -> Column:
    parts = F.transform(F.split(s, "\n", -1), _paragraph)
    return _let(parts, lambda x: _node(F.transform(x, lambda y: y["d"]), F.transform(x, lambda y: y["s"]), ":", ","))


def fingerprint(text: Column) -> Column:
    """The fingerprint string of a text."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), BLANK_LINES, -1), _section)
    whole = lambda t: F.sha2(F.concat(F.lit("|"), F.array_join(F.transform(t, lambda x: x["d"]), "")), 256)
    return _let(parts, lambda t: F.concat(whole(t), F.lit("|"), F.array_join(F.transform(t, lambda x: x["s"]), "|")))


def root(fp: Column) -> Column:
    """The root digest; equal roots mean equal texts, but for collisions of 128 bits."""
    return F.substring(fp, 1, 64)


def pieces(fp: Column) -> Column:
    """The labels of a fingerprint's pieces, in order."""
    return F.regexp_extract_all(F.substring(fp, 66, 1 << 30), F.lit(r"[=.]([0-9a-f]+)"), F.lit(1))


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct pieces that two fingerprints have in common, of the longer's; 1 only for equal roots."""
    sets = F.struct(F.array_distinct(pieces(a)).alias("a"), F.array_distinct(pieces(b)).alias("b"))
    part = _let(
        sets,
        lambda x: _let(
            F.greatest(F.size(x["a"]), F.size(x["b"]), F.lit(1)),
            lambda n: F.least(F.size(F.array_intersect(x["a"], x["b"])) / n, 1 - 1 / (1 + n)),
        ),
    )
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(part.cast("double"))


def changed_sections(a: Column, b: Column) -> Column:
    """Positions (from 0) of sections whose digests differ between two fingerprints: where an edit lies."""
    digests = lambda fp: F.transform(F.split(F.substring(fp, 66, 1 << 30), r"\|"), lambda s: F.substring(s, 1, LABEL))
    x, y = digests(a), digests(b)
    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(x), F.size(y)) - 1), lambda i: ~F.get(x, i).eqNullSafe(F.get(y, i)))


def with_next(docs: DataFrame, names: list[str]) -> DataFrame:
    """Each document with ``next_<name>`` of the next one by ascending doc_id (after the last: the first).

    Documents are dealt once, into ranges of doc_id cut at sampled quantiles; the next of a range's
    last document comes from a table of the ranges' first documents, joined by range.  Rows of equal
    doc_id follow in the order of their texts' hashes; null ids come first.
    """
    n = range_count(docs)
    rate = min(1.0, SAMPLE / max(docs.count(), 1))
    drawn = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 20)) <= F.lit(int(rate * (1 << 20)))
    sample = sorted(r[0] for r in docs.where(F.col("doc_id").isNotNull() & drawn).select("doc_id").collect())
    bounds = sorted({sample[i * len(sample) // n] for i in range(1, n)}) if sample else []
    rows = docs.withColumns({"_range": in_range(F.col("doc_id"), bounds), "_tie": F.xxhash64("text")})
    key = F.struct("doc_id", "_tie")
    one = Window.partitionBy(F.lit(0))  # over one row a range
    firsts = rows.select("_range", "doc_id", "_tie").groupBy("_range").agg(F.min(key).alias("_key"))
    firsts = materialize(
        firsts.select(
            F.coalesce(F.lag("_range").over(one.orderBy("_range")), F.max("_range").over(one)).alias("_before"),
            F.col("_key.doc_id").alias("_id"), F.col("_key._tie").alias("_t"),
        ),
        "range-firsts",
    )
    is_first = rows["doc_id"].eqNullSafe(firsts["_id"]) & (rows["_tie"] == firsts["_t"])
    firsts = rows.join(F.broadcast(firsts), is_first)  # at most n keys
    firsts = firsts.groupBy("_before").agg(*[F.first(rows[c]).alias(f"_first_{c}") for c in names])
    w = Window.partitionBy("_range").orderBy(F.col("doc_id").asc_nulls_first(), "_tie")
    rows = rows.withColumns({f"_next_{c}": F.lead(c).over(w) for c in names} | {"_last": F.lead(F.lit(1)).over(w).isNull()})
    joined = rows.join(firsts, (F.col("_range") == F.col("_before")) & F.col("_last"), "left")
    nexts = {f"next_{c}": F.when(F.col("_last"), F.col(f"_first_{c}")).otherwise(F.col(f"_next_{c}")) for c in names}
    return joined.withColumns(nexts).select(*docs.columns, *nexts)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit (last half replaced by the next document's start)."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(base, ["text"])
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), fingerprint(F.col("text")).alias("fingerprint"),
        fingerprint(F.col("next_text")).alias("next_fingerprint"), edited.alias("_edited"),
    ).withColumn("edited_fingerprint", fingerprint(F.col("_edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
