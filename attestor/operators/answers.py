"""JSON values in what a model says: fenced, with text in front or behind, or broken off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strings with their escapes, single brackets, a quote that opens no whole string, and what lies between.
TOKENS = r'(?s)"(?:[^"\\]++|\\.)*+"|[\[\]{}]|[^"\[\]{}]++|"'

UNCLOSED = 1 << 24


def first_value(text: Column, opens: str = "{[") -> Column:
    """The first complete bracketed value from the first of ``opens`` on, as text; null where none is or it doesn't end.

    The text is cut into tokens that are folded with the depth of open brackets.  Brackets in strings are part of
    their token, a quote that is never closed ends all hope, and the fold stands still where the depth has come back to none.
    """
    found = F.regexp_extract(text, rf"(?s)[{''.join(chr(92) + c for c in opens)}].*", 0)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("size"), F.lit(False).alias("done"))

    def step(acc: Column, token: Column) -> Column:
        depth = acc["depth"] + F.when(token.isin("{", "["), 1).when(token.isin("}", "]"), -1).when(token == '"', UNCLOSED).otherwise(0)
        return F.when(acc["done"], acc).otherwise(F.struct(depth.alias("depth"), (acc["size"] + F.length(token)).alias("size"), (depth <= 0).alias("done")))

    end = F.aggregate(F.regexp_extract_all(found, F.lit(TOKENS), F.lit(0)), start, step)
    return F.get(F.transform(F.array(end), lambda e: F.when(e["done"], F.substring(found, F.lit(1), e["size"]))), F.lit(0))


def value(text: Column) -> Column:
    """An answer as a variant: the text itself; else what lies from the first brace to the last; else the first
    complete object; else null."""
    greedy = F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(greedy), F.try_parse_json(first_value(text, "{")))


def listed(text: Column, name: str = "records") -> Column:
    """array<variant>: the items of the answer's first value, a list or an object with a list of that name; else empty."""
    v = F.try_parse_json(first_value(text))
    items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(v, f"$.{name}", "array<variant>"))
    return F.coalesce(items, F.array().cast("array<variant>"))
