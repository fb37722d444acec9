"""Texts as rows: page marks, chunks, lines, carried headers, sections and key-value maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestor.functions.exprs import LINE_END, strip, to_int

PAGE_MARK = "[[PAGE "
#: Code points that a chunk holds at most, unless a page alone has more.
CHUNK = 7000


def page_marked(number: Column, body: Column) -> Column:
    """A page as it stands in a page-marked text."""
    return F.concat(F.lit("\n[[PAGE "), number.cast("string"), F.lit("]]\n"), strip(body), F.lit("\n"))


def marked_texts(pages: DataFrame, key: str, number: str, body: str) -> DataFrame:
    """(key, text): all pages of each document, marked and in order."""
    marked = pages.select(key, F.col(number).alias("_n"), page_marked(F.col(number), F.col(body)).alias("_p"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("_n", "_p"))), lambda x: x["_p"])
    return marked.groupBy(key).agg(F.array_join(parts, "").alias("text"))


def page_count(text: Column) -> Column:
    """How often a page mark begins in a text."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(PAGE_MARK), F.lit("")))) / len(PAGE_MARK)).cast("int")


def chunks(text: Column, size: int = CHUNK) -> Column:
    """Pages packed greedily into chunks of at most ``size`` code points; joined they are the text."""
    pages = F.filter(F.split(text, r"(?=\n\[\[PAGE )", -1), lambda p: p != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))
    packed = F.aggregate(
        pages,
        start,
        lambda acc, p: F.when(
            (F.length(acc["open"]) + F.length(p) > size) & (acc["open"] != ""),
            F.struct(F.concat(acc["done"], F.array(acc["open"])).alias("done"), p.alias("open")),
        ).otherwise(F.struct(acc["done"].alias("done"), F.concat(acc["open"], p).alias("open"))),
        lambda acc: F.when(acc["open"] != "", F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]),
    )
    return F.when(F.length(text) <= size, F.array(text)).otherwise(packed)


def request_id(document: Column, index: Column) -> Column:
    """A stable id of a chunk."""
    return F.concat(F.lit("d"), F.substring(F.sha1(document), 1, 16), F.lit("-c"), index.cast("string"))


def first_by_content(docs: DataFrame, order: str, key: str = "document_id") -> DataFrame:
    """The first document of each content; copies are combined before the shuffle."""
    first = docs.groupBy(key).agg(F.min_by(F.struct(*docs.columns), F.struct(order)).alias("_row"))
    return first.select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in docs.columns])


def requests(docs: DataFrame, order: str, size: int = CHUNK, max_chunks: int | None = None) -> DataFrame:
    """(custom_id, document_id, chunk_index, chunk): what is to be extracted, each content once."""
    parts = chunks(F.col("text"), size)
    if max_chunks:
        parts = F.slice(parts, 1, max_chunks)
    rows = first_by_content(docs, order).select("document_id", F.posexplode(parts).alias("chunk_index", "chunk"))
    return rows.select(request_id(F.col("document_id"), F.col("chunk_index")).alias("custom_id"), "document_id", "chunk_index", "chunk")


def lines(docs: DataFrame) -> DataFrame:
    """Documents with one row a line that isn't blank: ``line_no`` (from 0, blanks counted) and ``line``, stripped."""
    keep = [c for c in docs.columns if c != "text"]
    rows = docs.select(*keep, F.posexplode(F.split("text", LINE_END, -1)).alias("line_no", "line"))
    return rows.withColumn("line", strip(F.col("line"))).where("line <> ''")


def carried(key: Sequence[str], order: str) -> Window:
    """The rows of a document up to the present one."""
    return Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def carry(value: Column, w: Window) -> Column:
    """The last value that isn't null, up to here; an empty text is a value."""
    return F.last(value, ignorenulls=True).over(w)


def header_value(line: Column, prefix: str) -> Column:
    """What follows a header's colon, where a line begins with it (in any case)."""
    return F.when(F.startswith(F.lower(line), F.lit(prefix)), strip(F.substring(line, len(prefix) + 1, 1 << 30)))


def header_year(value: Column) -> Column:
    """A header's year; null, which keeps the former, where it can't be read or is 0."""
    return F.nullif(to_int(value), F.lit(0))


def key_values(line: Column, pattern: str) -> Column:
    """Map of a line's ``key: value`` pairs: keys lower-cased, the last of equal keys counts."""
    keys = F.transform(F.regexp_extract_all(line, F.lit(pattern), F.lit(1)), lambda k: F.lower(strip(k)))
    values = F.transform(F.regexp_extract_all(line, F.lit(pattern), F.lit(2)), lambda v: strip(v))

    def pairs(x: Column) -> Column:
        made = F.zip_with(x["k"], x["v"], lambda k, v: F.struct(k.alias("key"), v.alias("value")))
        return F.filter(made, lambda p, i: ~F.array_contains(F.slice(F.concat(x["k"], F.array(F.lit("\0"))), i + 2, F.size(x["k"])), p["key"]))

    # one element, by which the line is cut once and not once a pair
    once = F.array(F.struct(keys.alias("k"), values.alias("v")))
    return F.transform(once, lambda x: F.map_from_entries(pairs(x)))[0]


def figure_pages(pages: DataFrame, key: str, most: int = 12, least_drawings: int = 12) -> DataFrame:
    """Pages that likely hold a figure: a caption and images or many drawings; the most drawn of each document."""
    caption = F.col("body").rlike(r"(?im)^\s{0,8}(figure|exhibit|chart)\s*\d")
    drawn = (F.col("n_images") > 0) | (F.col("n_drawings") >= least_drawings)
    w = Window.partitionBy(key).orderBy(F.col("n_drawings").desc(), F.col("page_no").desc())
    return pages.where(caption & drawn).withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= most).drop("_nth")
