"""Label-free verification: axioms, bounded logic, grounding and a second extraction, fused into trust.

Each record gets signals (score, ok, weight, detail); trust is their weighted geometric mean, with a
ceiling where any signal fails.  Everything is column expressions on the records' own rows; only
group axioms (aggregates joined back), the document texts and the second extraction (joins) shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.functions import exprs as E
from attestor.functions import intervals as I
from attestor.operators.constraints import Axiom, prepared

SOFT_PENALTY = 0.25
DEFAULT_TRUST, FAIL_CEILING = 0.8, 0.05
REVIEW_BELOW = 0.85
#: Numeric fields whose values must show in a cited span, by what their names contain.
SALIENT = ("rate", "ratio", "numerator", "denominator", "deaths", "pct")
SIGNAL = "struct<name:string,score:double,ok:boolean,weight:double,detail:string>"
FLAGS = "array<struct<msg:string,fail:boolean>>"


def signal(name: str, score: Column | float | None, ok: Column | bool | None, weight: Column | float, detail: Column | str) -> Column:
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        F.lit(name).alias("name"), col(score).cast("double").alias("score"), col(ok).cast("boolean").alias("ok"),
        col(weight).cast("double").alias("weight"), col(detail).alias("detail"),
    )


def flag(msg: Column, fail: bool = False, when: Column | None = None) -> Column:
    """A candidate flag; null where it isn't raised."""
    f = F.struct(msg.alias("msg"), F.lit(fail).alias("fail"))
    return f if when is None else F.when(when, f)


def _once(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``x``, which is evaluated once however often ``use`` names it."""
    return F.transform(F.array(x), use)[0]


def raise_flags(old: Column, new: Sequence[Column]) -> Column:
    """``old`` and those of ``new`` that aren't null, in order, each message once (failing if ever raised so).

    Most rows raise no message twice; they are done with once the messages are counted.
    """
    had = F.coalesce(old, F.array().cast(FLAGS))
    every = F.concat(had, F.filter(F.array(*new).cast(FLAGS), lambda x: x.isNotNull())) if new else had
    once = lambda e: F.transform(
        F.array_distinct(F.transform(e, lambda x: x["msg"])),
        lambda m: F.struct(m.alias("msg"), F.exists(e, lambda x: (x["msg"] == m) & x["fail"]).alias("fail")),
    )
    apart = lambda e: F.size(F.array_distinct(F.transform(e, lambda x: x["msg"]))) == F.size(e)
    return _once(every, lambda e: F.when(F.size(e) <= 1, e).when(apart(e), e).otherwise(once(e).cast(FLAGS)))


def status(flags: Column) -> Column:
    """``fail`` if any flag fails, ``warn`` if there is any, else ``pass``."""
    return F.when(F.exists(flags, lambda x: x["fail"]), "fail").when(F.size(flags) > 0, "warn").otherwise("pass")


def status_with(old: Column, new: Sequence[tuple[Column, bool]]) -> Column:
    """``status`` of the flags ``old`` and those raised by ``new``, conditions and whether they fail; builds no flag."""
    some = F.coalesce(F.size(old) > 0, F.lit(False))
    bad, any_ = some & F.coalesce(F.exists(old, lambda x: x["fail"]), F.lit(False)), some
    for when, fail in new:
        any_ = any_ | F.coalesce(when, F.lit(False))
        bad = bad | F.coalesce(when, F.lit(False)) if fail else bad
    return F.when(bad, "fail").when(any_, "warn").otherwise("pass")


def with_outcomes(records: DataFrame, axioms: Sequence[Axiom]) -> DataFrame:
    """Each axiom evaluated once: ``_ok_<name>`` and, where that is false, ``_say_<name>``."""
    out = prepared(records, axioms)
    if axioms:
        out = out.withColumns({f"_ok_{a.name}": a.outcome for a in axioms})
        out = out.withColumns({f"_say_{a.name}": F.when(~F.col(f"_ok_{a.name}"), a.detail) for a in axioms})
    return out


def _violated(a: Axiom) -> Column:
    return F.coalesce(~F.col(f"_ok_{a.name}"), F.lit(False))


def symbolic(axioms: Sequence[Axiom]) -> tuple[Column, list[Column], list[tuple[Column, bool]]]:
    """Signal of the axioms, the flags that they raise, and when they raise them (and whether failing)."""
    bad = {a.name: _violated(a) for a in axioms}
    say = {a.name: F.concat(F.lit(f"{a.name}: "), F.col(f"_say_{a.name}")) for a in axioms}
    count = lambda kind: sum((bad[a.name].cast("int") for a in axioms if a.severity == kind), F.lit(0))
    hard, soft = count("hard"), count("soft")
    text = F.concat_ws("; ", *[F.when(bad[a.name], say[a.name]) for a in axioms])
    detail = F.when((hard == 0) & (soft == 0), "all domain constraints satisfied").otherwise(text)
    score = F.when(hard > 0, 0.0).otherwise(F.pow(F.lit(1 - SOFT_PENALTY), soft))
    flags = [flag(say[a.name], a.severity == "hard", bad[a.name]) for a in axioms]
    return signal("symbolic", score, hard == 0, 2.0, detail), flags, [(bad[a.name], a.severity == "hard") for a in axioms]


def bounded_logic(axioms: Sequence[Axiom]) -> Column:
    """Signal of the proposition that all hard axioms hold, asserted true: does it contradict its bounds?"""
    hard = [a for a in axioms if a.severity == "hard"]
    validity = I.conjunction([I.of_bool(F.col(f"_ok_{a.name}")) for a in hard])
    against = I.contradicts(I.asserted(validity))
    names = F.concat_ws(", ", *[F.when(_violated(a), F.lit(a.name)) for a in hard])
    detail = F.when(against, F.concat(F.lit("logical contradiction; violated axiom(s): "), names)).otherwise("no logical contradiction")
    return signal("lnn", validity["upper"], ~against, F.when(against, 2.0).otherwise(1.0), detail)


def salient_fields(records: DataFrame) -> list[tuple[str, str]]:
    """Numeric columns whose values a cited span must show."""
    kinds = ("int", "bigint", "double", "float")
    return [(n, t) for n, t in records.dtypes if t in kinds and not n.startswith("_") and any(h in n for h in SALIENT) and n not in ("trust_score",)]


def grounding(records: DataFrame, span: Column, text: Column, body: Column | None = None) -> Column:
    """Signal of whether the cited span stands in the document and shows the record's values.

    ``body`` is the text's normal form where that is known.
    """
    cited, body = E.normal_text(span), E.normal_text(text) if body is None else body
    found = F.when(E.blank_to_null(text).isNotNull(), F.contains(body, cited))
    values = [E.short_number(F.col(n)) if t in ("double", "float") else F.col(n).cast("string") for n, t in salient_fields(records)]
    missing = F.array(*[F.when(~F.contains(cited, F.lower(v)), v) for v in values]).cast("array<string>")
    gone = F.array_join(F.filter(missing, lambda x: x.isNotNull()), ", ")
    none = E.blank_to_null(span).isNull()
    return (
        F.when(none, signal("grounding", None, None, 1.0, "no source span"))
        .when(found == F.lit(False), signal("grounding", 0.0, False, 1.0, "cited span not found in source document"))
        .when(gone != "", signal("grounding", 0.1, False, 1.0, F.concat(F.lit("cited span omits value(s): "), gone)))
        .otherwise(signal("grounding", 1.0, True, 1.5, "values grounded in cited span"))
    )


def last_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key; rows of a hot key are combined before the shuffle.

    The keys' hash leads, so that rows are sorted by one number.
    """
    last = df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(order)).alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


PIECES = ("score", "ok", "weight", "detail")


def _second_read(primary: DataFrame, secondary: DataFrame, keys: Sequence[str], fields: Sequence[str], compared: Column | None, tolerance: float) -> DataFrame:
    """``primary`` with the pieces of the second extraction's signal as columns ``_e_<piece>``; all null where it takes no part."""
    here = F.lit(True) if compared is None else compared
    read = [f for f in fields if f not in keys]
    second = last_by(secondary.where(here).select(*keys, *[F.col(f).alias(f"_2_{f}") for f in read], "record_seq"), keys, "record_seq")
    types = dict(primary.dtypes)
    second = second.select(F.xxhash64(*keys).alias("_hash"), *[F.col(k).alias(f"_k_{k}") for k in keys], *[f"_2_{f}" for f in read], F.lit(True).alias("_matched"))
    cond = here & (F.xxhash64(*keys) == F.col("_hash")) & E.all_same([F.col(k) for k in keys], [F.col(f"_k_{k}") for k in keys])
    other = lambda f: F.col(f"_k_{f}") if f in keys else F.col(f"_2_{f}")
    numeric = ("int", "bigint", "double", "float")
    same = {f"_same_{f}": E.agree(F.col(f), other(f), types[f] in numeric, tolerance) for f in fields}
    joined = primary.join(second, cond, "left")
    joined = joined.withColumns(same) if same else joined
    n = sum((F.when(F.col(c), 0).otherwise(1) for c in same), F.lit(0)).cast("int")
    joined = joined.withColumn("_apart", n)
    shown = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    apart = [F.when(~F.col(f"_same_{f}"), F.concat(F.lit(f"{f} ("), shown(F.col(f)), F.lit(" vs "), shown(other(f)), F.lit(")"))) for f in fields]
    alone, some = F.col("_matched").isNull(), F.col("_apart") > 0
    of = lambda none, differ, agree: F.when(~here, None).when(alone, none).when(some, differ).otherwise(agree)
    pieces = {
        "score": of(F.lit(0.5), (len(fields) - F.col("_apart")) / max(1, len(fields)), F.lit(1.0)),
        "ok": F.when(here & ~alone & ~some, True),
        "weight": of(F.lit(1.0), F.lit(1.5), F.lit(1.5)),
        "detail": of(
            F.lit("no corroborating extraction from 2nd model"), F.concat(F.lit("models disagree on: "), F.concat_ws(", ", *apart)), F.lit("2nd model agrees on all fields")
        ),
    }
    told = joined.withColumns({"_e_disagree": here & ~alone & some, **{f"_e_{p}": pieces[p] for p in PIECES}})
    return told.select(*primary.columns, "_e_disagree", *[f"_e_{p}" for p in PIECES])


def _second_signal() -> Column:
    """The signal of ``_second_read``'s pieces."""
    return F.when(F.col("_e_weight").isNotNull(), signal("ensemble", *[F.col(f"_e_{p}") for p in PIECES]))


def reconcile(
    primary: DataFrame, secondary: DataFrame, keys: Sequence[str], fields: Sequence[str], compared: Column | None = None, tolerance: float = 0.01
) -> DataFrame:
    """``primary`` with ``_ensemble``: the signal of a second extraction of the same records.

    Keys equal each other where both are null; of equal secondary keys the last counts.  ``compared``
    says which records take part (a column of both); the others get a null signal.
    """
    told = _second_read(primary, secondary, keys, fields, compared, tolerance)
    return told.select(*primary.columns, _second_signal().alias("_ensemble"))


def omissions(primary: DataFrame, secondary: DataFrame, keys: Sequence[str], compared: Column | None = None) -> DataFrame:
    """Secondary records (the last of each key) that no primary record matches."""
    here = F.lit(True) if compared is None else compared
    second = last_by(secondary.where(here), keys, "record_seq")
    first = primary.where(here).select(F.xxhash64(*keys).alias("_hash"), *[F.col(k).alias(f"_k_{k}") for k in keys])
    same = (F.xxhash64(*keys) == F.col("_hash")) & E.all_same([F.col(k) for k in keys], [F.col(f"_k_{k}") for k in keys])
    return second.join(first, same, "left_anti")


def fuse(signals: Column) -> Column:
    """Trust from an array of signals."""
    scored = F.filter(signals, lambda s: s["score"].isNotNull())
    add = lambda f: F.aggregate(scored, F.lit(0.0), lambda acc, s: acc + f(s))
    weight = add(lambda s: s["weight"])
    logs = add(lambda s: s["weight"] * F.ln(F.least(F.greatest(s["score"], F.lit(1e-6)), F.lit(1.0))))
    trust = F.when(weight > 0, F.exp(logs / weight)).otherwise(DEFAULT_TRUST)
    failed = F.exists(signals, lambda s: s["ok"] == F.lit(False))
    return F.round(F.when(F.coalesce(failed, F.lit(False)), F.least(trust, F.lit(FAIL_CEILING))).otherwise(trust), 4)


def fused(signals: Sequence[Column | dict[str, Column]]) -> Column:
    """``fuse`` of signals that are columns (or their parts) of their own, of which any may be null: sums without an array."""
    weight, logs, failed = F.lit(0.0), F.lit(0.0), F.lit(False)
    for s in signals:
        some = s["score"].isNotNull()
        weight = weight + F.when(some, s["weight"]).otherwise(0.0)
        logs = logs + F.when(some, s["weight"] * F.ln(F.least(F.greatest(s["score"], F.lit(1e-6)), F.lit(1.0)))).otherwise(0.0)
        failed = failed | F.coalesce(s["ok"] == F.lit(False), F.lit(False))
    trust = F.when(weight > 0, F.exp(logs / weight)).otherwise(DEFAULT_TRUST)
    return F.round(F.when(failed, F.least(trust, F.lit(FAIL_CEILING))).otherwise(trust), 4)


def verify(
    records: DataFrame,
    axioms: Sequence[Axiom],
    texts: DataFrame | None = None,
    second: DataFrame | None = None,
    keys: Sequence[str] = (),
    fields: Sequence[str] = (),
    compared: Column | None = None,
    review_below: float = REVIEW_BELOW,
) -> DataFrame:
    """Records with ``signals``, ``trust_score``, ``qa_flags``, ``qa_status`` and ``review_recommended``.

    ``records`` has record_seq, qa_flags (array<struct<msg, fail>>) and, for grounding, a provenance
    struct with source_document_id and source_span; ``texts`` is (document_id, text).
    """
    columns = records.columns
    out = with_outcomes(records, axioms)
    sym, flags, raised = symbolic(axioms)
    parts, names = [sym, bounded_logic(axioms)], ["symbolic", "lnn"]
    if "provenance" in columns:
        if texts is not None:
            # a document's text is brought to its normal form once, not once a record
            body = texts.select(F.col("document_id").alias("_doc"), F.col("text").alias("_text"), E.normal_text(F.col("text")).alias("_body"))
            out = out.join(body, F.col("provenance.source_document_id") == F.col("_doc"), "left")
        else:
            out = out.withColumns({"_text": F.lit(None).cast("string"), "_body": F.lit(None).cast("string")})
        out = out.withColumn("_ground", grounding(records, F.col("provenance.source_span"), F.col("_text"), F.col("_body")))
        parts.append(F.col("_ground"))
        names.append("grounding")
        lost = F.col("_ground.ok") == F.lit(False)
        flags.append(flag(F.concat(F.lit("grounding: "), F.col("_ground.detail")), True, lost))
        raised.append((lost, True))
    if second is not None:
        out = _second_read(out, second, keys, fields, compared, 0.01)
        flags.append(flag(F.col("_e_detail"), False, F.col("_e_disagree")))
        raised.append((F.col("_e_disagree"), False))
    # each signal's parts are columns of their own: what only needs scores builds no detail
    out = out.withColumns({f"_p{i}_{n}": p[n] for i, p in enumerate(parts) for n in PIECES})
    each = [{n: F.col(f"_p{i}_{n}") for n in PIECES} for i in range(len(parts))]
    always = [signal(name, *x.values()).cast(SIGNAL) for name, x in zip(names, each, strict=True)]
    signals = F.array(*always)
    if second is not None:
        each.append({n: F.col(f"_e_{n}") for n in PIECES})
        signals = F.when(F.col("_e_weight").isNull(), signals).otherwise(F.array(*always, _second_signal().cast(SIGNAL)))
    had = F.col("qa_flags")
    # the status is told from what raises flags: rows that are only counted build no message
    out = out.withColumns({"signals": signals, "_flags": raise_flags(had, flags), "_status": status_with(had, raised), "trust_score": fused(each)})
    out = out.withColumns({"qa_flags": F.col("_flags"), "qa_status": F.col("_status")})
    review = (F.col("qa_status") == "fail") | (F.col("trust_score") < review_below)
    added = [c for c in ("signals", "trust_score", "qa_flags", "qa_status", "review_recommended") if c not in columns]
    return out.withColumn("review_recommended", review).select(*columns, *added)


def summarize(scored: DataFrame, omitted: Column | int = 0) -> DataFrame:
    """One row: counts by status, mean and least trust, records to review."""
    n = F.count(F.lit(1))
    review = F.count_if(F.col("review_recommended"))
    return scored.agg(
        n.alias("n_records"), *[F.count_if(F.col("qa_status") == s).alias(f"qa_{s}") for s in ("pass", "warn", "fail")],
        F.round(F.avg("trust_score"), 4).alias("mean_trust"), F.round(F.min("trust_score"), 4).alias("min_trust"),
        review.alias("review_recommended"), (n - review).alias("auto_acceptable"),
    ).withColumn("ensemble_omissions", (omitted if isinstance(omitted, Column) else F.lit(omitted)).cast("long"))
