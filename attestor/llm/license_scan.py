"""License scan: ordered signature rules over the words of a text, as expressions of one row.

1. A text becomes its words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z is lower-cased) with one space between
   them.  Places are counted in words from 0.
2. One pass with an alternation of the keywords finds those that the text holds; only the rules of these are tried.
3. A rule's matches are cut out together with what lies between them, so that counting words gives their places.
4. A detection goes if another one contains its interval that has a higher priority; or an equal priority and a
   longer interval; or the same interval and priority and an earlier rule.  Detections are sorted so that what may
   contain one stands before it, and go through this in chunks that take along only intervals still open: the
   work grows with the number of detections, not with its square.

Base phrases (``BASE``) are counted at every place and their labels stay, whatever contains them.

A null or empty text has no words and no detections, score 0.  Repeated rows give equal results, ids play no part, other
columns stay; one named as the output column is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.llm import license_rules

#: Phrases whose every place counts, with their labels; fixed by the query's contract.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: What a detection of a priority is worth as evidence of a license.
WORTH = {1: 0.4, 2: 0.7, 3: 0.9, 4: 1.0}
#: Detections resolved at once.
CHUNK = 64

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DETECTION = "struct<start:int,size:int,priority:int,rule:int,label:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def word_line(text: Column) -> Column:
    """The words of a text with one space between them."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def word_count(line: Column) -> Column:
    """Number of words of a line of words; of white space and nothing 0."""
    line = F.trim(line)
    return F.when(line == "", 0).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def whole(pattern: str) -> str:
    """A pattern that matches whole words only."""
    return f"(?<![^ ])(?:{pattern})(?![^ ])"


def trie(words: list[str]) -> str:
    """A pattern that matches any of the words and tries each letter once."""
    if words == [""]:
        return ""
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[:1], []).append(w[1:])
    branches = [h + trie(rest) for h, rest in heads.items() if h]
    body = branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"
    return f"(?:{body})?" if "" in heads else body


def places(line: Column, pattern: Column, kind: Callable[[Column, Column], Column]) -> Column:
    """``kind(start, size)`` of each match of a whole-word pattern in a line of words, from left to right."""

    def found(matches: Column) -> Column:
        between = F.split(line, pattern, -1)
        # words up to the match: those between, and those of the matches before
        sizes = F.zip_with(between, matches, lambda b, m: F.struct(word_count(b).alias("gap"), word_count(F.coalesce(m, F.lit(""))).alias("size")))
        shape = "array<struct<start:int,size:int>>"

        def walk(at: Column, part: Column) -> Column:
            return F.aggregate(
                part,
                F.struct(at.alias("at"), F.array().cast(shape).alias("out")),
                lambda acc, x: F.struct(
                    (acc["at"] + x["gap"] + x["size"]).alias("at"),
                    F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), x["size"].alias("size")))).alias("out"),
                ),
            )

        def walked(all_: Column) -> Column:  # in chunks, as every step copies what the fold holds
            blocks = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / F.lit(4 * CHUNK)).cast("int"))
            start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{shape}>").alias("out"))
            return F.flatten(
                F.aggregate(
                    blocks,
                    start,
                    lambda acc, k: let(
                        walk(acc["at"], F.slice(all_, k * (4 * CHUNK) + 1, 4 * CHUNK)),
                        lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], F.array(x["out"])).alias("out")),
                    ),
                )["out"]
            )

        return F.transform(let(F.slice(sizes, 1, F.size(matches)), walked), lambda p: kind(p["start"], p["size"]))

    matches = F.regexp_extract_all(line, pattern, F.lit(0))
    return let(matches, lambda m: F.when(F.size(m) > 0, found(m)).otherwise(F.array().cast(f"array<{DETECTION}>")))


def _empty() -> Column:
    return F.array().cast(f"array<{DETECTION}>")


def resolve(detections: Column, chunk: int = CHUNK) -> Column:
    """The detections that no other one suppresses, by place."""

    def beats(o: Column, d: Column) -> Column:
        wider = (o["size"] > d["size"]) | ((o["size"] == d["size"]) & (o["rule"] < d["rule"]))
        holds = (o["start"] <= d["start"]) & (o["start"] + o["size"] >= d["start"] + d["size"])
        return holds & ((o["priority"] > d["priority"]) | ((o["priority"] == d["priority"]) & wider))

    def swept(ordered: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            def one(part: Column) -> Column:
                around = F.concat(acc["open"], part)
                kept = let(around, lambda all_: F.filter(part, lambda d: ~F.exists(all_, lambda o: beats(o, d))))
                last = F.element_at(part, -1)["start"]
                still = F.filter(around, lambda o: o["start"] + o["size"] > last)
                return F.struct(F.concat(acc["kept"], F.array(kept)).alias("kept"), still.alias("open"))

            return let(F.slice(ordered, k * chunk + 1, chunk), one)

        start = F.struct(F.array().cast(f"array<array<{DETECTION}>>").alias("kept"), _empty().alias("open"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(ordered) - 1) / F.lit(chunk)).cast("int"))
        return F.flatten(F.aggregate(blocks, start, step)["kept"])

    keyed = F.transform(detections, lambda d: F.struct(d["start"].alias("start"), (-d["size"]).alias("size"), (-d["priority"]).alias("priority"), d["rule"].alias("rule"), d["label"].alias("label")))
    back = lambda d: F.struct(d["start"].alias("start"), (-d["size"]).alias("size"), (-d["priority"]).alias("priority"), d["rule"].alias("rule"), d["label"].alias("label"))
    return F.when(F.size(detections) > 0, let(F.transform(F.array_sort(keyed), back), swept)).otherwise(_empty())


def _rule_table(rules: list[tuple[int, str, str, str]]) -> Column:
    quoted = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = [f"named_struct('rule', {k}, 'priority', {p}, 'label', {quoted(label)}, 'keyword', {quoted(w)}, 'pattern', {quoted(whole(x))})" for k, (p, label, w, x) in enumerate(rules)]
    return F.expr(f"array({', '.join(rows)})")


def detect(line: Column, rules: list[tuple[int, str, str, str]]) -> Column:
    """All matches of the rules whose keyword stands in a line of words: array of ``DETECTION``, rule by rule."""
    keywords = whole(trie(sorted({w for _, _, w, _ in rules})))
    held = F.array_distinct(F.regexp_extract_all(line, F.lit(keywords), F.lit(0)))

    def tried(present: Column) -> Column:
        def of(r: Column) -> Column:
            return places(line, r["pattern"], lambda start, size: F.struct(start.alias("start"), size.alias("size"), r["priority"].alias("priority"), r["rule"].alias("rule"), r["label"].alias("label")))

        return F.flatten(F.transform(F.filter(_rule_table(rules), lambda r: F.array_contains(present, r["keyword"])), of))

    return let(held, lambda present: F.when(F.size(present) > 0, tried(present)).otherwise(_empty()))


def base_places(line: Column) -> Column:
    """Every place of a base phrase: array of ``DETECTION`` with rules -1 downwards."""
    found = []
    for k, (phrase, label) in enumerate(BASE):
        one = places(line, F.lit(whole(phrase)), lambda start, size, k=k, label=label: F.struct(
            start.alias("start"), size.alias("size"), F.lit(1).alias("priority"), F.lit(-1 - k).alias("rule"), F.lit(label).alias("label")
        ))
        found.append(F.when(F.contains(line, F.lit(phrase)), one).otherwise(_empty()))
    return F.concat(*found)


def scan_licenses(docs: DataFrame, rules: list[tuple[int, str, str, str]] | None = None, out: str = "licenses") -> DataFrame:
    """Add ``licenses``: struct of n_words, base and found (arrays of start, size, priority, rule, label).

    ``found`` holds what is left of the rules' detections, by place; ``base`` every place of a base phrase.
    """
    rules = license_rules.rules() if rules is None else rules
    made = let(
        word_line(F.col("text")),
        lambda line: F.struct(
            word_count(line).cast("long").alias("n_words"), base_places(line).alias("base"), let(detect(line, rules), resolve).alias("found")
        ),
    )
    return docs.withColumn(out, made)


def labels(*detections: Column) -> Column:
    """Distinct labels, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(F.concat(*detections), lambda d: d["label"]))), ",")


def score(found: Column, base: Column) -> Column:
    """Evidence of a license, 0 to 1: what the best detection is worth."""
    worth = F.expr("map(" + ", ".join(f"{k}, {v}D" for k, v in WORTH.items()) + ")")
    return F.coalesce(F.array_max(F.transform(F.concat(found, base), lambda d: F.element_at(worth, d["priority"]))), F.lit(0.0))
