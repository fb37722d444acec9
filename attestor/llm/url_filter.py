r"""URL filters: rules first, then a character language-model ratio (DataFrame functions only).

Host and path are cut from a URL; rules (host, path, verdict) apply to their host and all its
subdomains if the path starts with theirs, the longest wins.  The URLs that rules accept and reject
train two smoothed Markov models of variable order over the characters of host and path: a context
of up to ``ORDER`` characters that was seen often enough predicts by Witten-Bell interpolation with
the next shorter one.  URLs without a rule are judged by the mean log-likelihood difference per
character, against a threshold calibrated on ruled URLs that were not trained on.

A null URL or one without ``://`` has an empty host and path and no characters: its ratio is 0.
Without URLs of both verdicts the ratio is 0 everywhere, and 0 is accepted.  Repeated URLs are counted as
often as they come and judged once; columns besides ``page_id`` and ``url`` are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.llm.scratch import materialize

#: Longest context, in characters.
ORDER = 4
#: A context of more than one character counts only if seen this often.
LEAST_SEEN = 2
#: Model rows up to which the model is broadcast; a larger one is joined by a shuffle, with hot keys spread.
BROADCAST_ROWS = 400_000
SPREAD = 16
#: One in so many ruled URLs calibrates the threshold instead of training.
HELD = 5
#: Resolution of the calibration.
STEP = 0.01
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def apply_rules(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (host and path of the longest that fits) and ``_verdict``."""
    pages = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    fits = [
        F.when(
            ((F.col("host") == h) | F.endswith(F.col("host"), F.lit(f".{h}"))) & F.startswith(F.col("path"), F.lit(p)),
            F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in rules
    ]
    best = F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    return pages.withColumn("_best", best).withColumns({"rule": F.col("_best.rule"), "_verdict": F.col("_best.verdict")}).drop("_best")


def _grams(urls: DataFrame, *keep: str) -> DataFrame:
    """One row a character of host and path: ``ctx`` (up to ORDER characters before it) and ``ch``."""
    text = F.concat(F.lit("^" * ORDER), F.col("host"), F.col("path"), F.lit("$"))
    at = F.sequence(F.lit(ORDER + 1), F.length(text))
    some = urls.where((F.col("host") != "") | (F.col("path") != "")).withColumn("_t", text)
    pair = F.transform(at, lambda i: F.substring(F.col("_t"), i - ORDER, F.lit(ORDER + 1)))
    return some.select(*keep, F.explode(pair).alias("_g")).select(
        *keep, F.substring("_g", 1, ORDER).alias("ctx"), F.substring("_g", ORDER + 1, 1).alias("ch")
    )


def train(ruled: DataFrame) -> DataFrame:
    """Table (n, ctx, ch, allow, block): how often a character followed the last n characters.

    Counted once by full context, over all ruled URLs; shorter contexts are sums of longer ones.
    """
    counts = [F.count(F.when(F.col("_verdict") == v, 1)).alias(v) for v in ("allow", "block")]
    full = materialize(_grams(ruled, "_verdict").groupBy("ctx", "ch").agg(*counts), "url-grams")
    parts = []
    for n in range(ORDER + 1):
        ctx = F.substring("ctx", ORDER - n + 1, n) if n else F.lit("")
        parts.append(full.groupBy(ctx.alias("ctx"), "ch").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).withColumn("n", F.lit(n)))
    return reduce(DataFrame.unionByName, parts)


def ratios(grams: DataFrame, model: DataFrame) -> DataFrame:
    """Log-likelihood difference (accepted - rejected) of each distinct (ctx, ch) of ``grams``.

    The model's contexts are few; the grams to be rated are distinct, so hot ones cost nothing more.
    """
    out = grams.select("ctx", "ch").distinct()
    letters = model.where("n = 0").agg(F.count("*")).first()[0] + 1
    out = out.withColumns({"pa": F.lit(1.0 / letters), "pb": F.lit(1.0 / letters)})
    for n in range(ORDER + 1):
        of = model.where(F.col("n") == n)
        ctx = of.groupBy("ctx").agg(
            *[F.sum(v).alias(f"c_{v}") for v in ("allow", "block")],
            *[F.count(F.when(F.col(v) > 0, 1)).alias(f"t_{v}") for v in ("allow", "block")],
        )
        if not n:  # one context, the empty one
            row = ctx.drop("ctx").first()
            totals = row.asDict() if row else dict.fromkeys(ctx.columns[1:], 0)
            out = out.join(of.select("ch", "allow", "block"), "ch", "left").withColumns({k: F.lit(v) for k, v in totals.items()})
        if n > 1:
            ctx = ctx.where(F.col("c_allow") + F.col("c_block") >= LEAST_SEEN)
        if n:
            out = out.withColumn("k", F.substring("ctx", ORDER - n + 1, n))
            out = out.join(ctx.withColumnRenamed("ctx", "k"), "k", "left")
            out = out.join(of.select(F.col("ctx").alias("k"), "ch", "allow", "block"), ["k", "ch"], "left")
        for p, v in (("pa", "allow"), ("pb", "block")):
            seen, total, kinds = (F.coalesce(F.col(c), F.lit(0)) for c in (v, f"c_{v}", f"t_{v}"))
            out = out.withColumn(p, F.when(total > 0, (seen + kinds * F.col(p)) / (total + kinds)).otherwise(F.col(p)))
        out = out.select("ctx", "ch", "pa", "pb")
    return out.select("ctx", "ch", (F.ln("pa") - F.ln("pb")).alias("d"))


def score(urls: DataFrame, key: str, model: DataFrame) -> DataFrame:
    """(key, ratio): mean log-likelihood difference per character of each URL; those without any are absent."""
    grams = _grams(urls, key)
    table = materialize(ratios(grams, model), "url-ratios")
    if table.count() <= BROADCAST_ROWS:
        joined = grams.join(F.broadcast(table), ["ctx", "ch"])
    else:  # the same rows by a shuffle; every ratio stands once in each of SPREAD parts
        spread = table.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        part = F.pmod(F.xxhash64(key), F.lit(SPREAD)).cast("int")
        joined = grams.withColumn("_part", part).join(spread, ["ctx", "ch", "_part"])
    return joined.groupBy(key).agg((F.sum("d") / F.count("d")).alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """The cut on ``ratio`` of least mean error rate of both verdicts, from counts by step (bounded rows)."""
    step = F.round(F.greatest(F.lit(-20.0), F.least(F.lit(20.0), "ratio")) / STEP).cast("int")
    rows = scored.groupBy(step.alias("s")).agg(*[F.count(F.when(F.col("_verdict") == v, 1)).alias(v) for v in ("allow", "block")]).collect()
    rows = sorted(rows, key=lambda r: r.s)
    good, bad = sum(r.allow for r in rows), sum(r.block for r in rows)
    if not good or not bad:
        return 0.0
    lost, kept, cuts = 0, bad, [(1.0, -rows[0].s * STEP)]
    for r, after in zip(rows, [*rows[1:], None], strict=True):
        lost, kept = lost + r.allow, kept - r.block
        cut = (r.s + (after.s if after else r.s + 1)) / 2 * STEP
        cuts.append((lost / good + kept / bad, cut))
    least = min(c[0] for c in cuts[1:])
    best = [c[1] for c in cuts[1:] if c[0] == least]
    return best[len(best) // 2]


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict (the rule's, else the models'), ratio (null where a rule fits)."""
    ruled = apply_rules(pages.select("page_id", "url"), rules)
    rows = ruled.groupBy("host", "path", "rule", "_verdict").agg(F.count(F.lit(1)).alias("_n"))  # equal addresses are judged once
    rows = materialize(rows.withColumn("_key", F.xxhash64("host", "path")), "url-addresses")
    known = rows.where("rule is not null")
    held = F.pmod(F.col("_key"), F.lit(HELD)) == 0
    model = materialize(train(known.where(~held)), "url-model")
    seen = {r[0] for r in known.where(~held).select("_verdict").distinct().collect()}
    if {"allow", "block"} <= seen:
        calibrating = score(known.where(held), "_key", model).join(known.where(held).select("_key", "_verdict"), "_key")
        cut = threshold(calibrating)
        ratio = score(rows.where("rule is null"), "_key", model)
    else:
        cut, ratio = 0.0, rows.select("_key", F.lit(0.0).alias("ratio")).where("false")
    ratio = ratio.withColumnRenamed("_key", "_k")
    out = ruled.withColumn("_key", F.xxhash64("host", "path")).join(ratio, (F.col("_key") == F.col("_k")) & F.col("rule").isNull(), "left")
    value = F.when(F.col("rule").isNull(), F.coalesce("ratio", F.lit(0.0)))
    verdict = F.coalesce("_verdict", F.when(value >= cut, "allow").otherwise("block"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), value.alias("ratio"))
