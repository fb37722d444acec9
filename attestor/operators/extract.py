"""Records from documents: by rules from canonical texts, or from recorded model payloads.

Both give one wide table per dataset: record_type, record_seq, the fields of all its kinds, provenance
and qa_flags.  Rows that lack a required field are kept apart by ``quarantine`` instead of stopping a run.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.functions import exprs as E
from attestor.operators import answers
from attestor.operators import text as T
from attestor.operators.verify import FLAGS, flag, raise_flags, status
from attestor.plans.datasets import EFFECT_DIRECTIONS, KINDS, SCOPE_SEVERITY, Dataset

PROVENANCE = (
    "struct<source_document_id:string,source_url:string,method:string,extractor_version:string,"
    "page_start:int,page_end:int,source_span:string,confidence:double>"
)
DOCUMENT = ("document_id", "source_url", "jurisdiction", "program", "publisher", "report_year")


def provenance(method: str, version: str, page: Column | None = None, confidence: Column | float | None = None, span: Column | None = None) -> Column:
    null = F.lit(None)
    conf = confidence if isinstance(confidence, Column) else F.lit(confidence)
    return F.struct(
        F.col("document_id").alias("source_document_id"), F.col("source_url").alias("source_url"), F.lit(method).alias("method"), F.lit(version).alias("extractor_version"),
        (null if page is None else page).cast("int").alias("page_start"), (null if page is None else page).cast("int").alias("page_end"),
        (null if span is None else span).cast("string").alias("source_span"), conf.cast("double").alias("confidence"),
    ).cast(PROVENANCE)


def all_fields(ds: Dataset) -> dict[str, str]:
    """Fields of all kinds of a dataset, in order of first naming."""
    return {f: t for k in ds.kinds for f, t in KINDS[k].fields.items()}


def _record(kind: str, ds: Dataset, given: dict[str, Column], seq: Column, prov: Column, flags: Column | None = None) -> Column:
    own = KINDS[kind].fields
    value = lambda f, t: (given[f] if f in own and f in given else F.lit(KINDS[kind].defaults.get(f)) if f in own else F.lit(None)).cast(t)
    return F.struct(
        F.lit(kind).alias("record_type"), seq.alias("record_seq"), *[value(f, t).alias(f) for f, t in all_fields(ds).items()],
        prov.alias("provenance"), (F.array() if flags is None else flags).cast(FLAGS).alias("qa_flags"),
    )


def normalize(records: DataFrame, ds: Dataset) -> DataFrame:
    """Normalised states and letters, the checks made on construction, and the QA status they give."""
    kinds = [KINDS[k] for k in ds.kinds]
    upper, bare = [k.name for k in kinds if k.upper_state], [k.name for k in kinds if k.strip_state]
    t, state = F.col("record_type"), F.col("state")
    records = records.withColumn("state", F.when(t.isin(*upper), F.upper(E.strip(state))).when(t.isin(*bare), E.strip(state)).otherwise(state) if upper + bare else state)
    if "scope_severity" in records.columns:
        records = records.withColumn("scope_severity", F.upper(E.strip(F.col("scope_severity"))))
    flags = raise_flags(F.col("qa_flags"), construct_flags(ds))
    return records.withColumn("qa_flags", flags).withColumn("qa_status", status(F.col("qa_flags")))


def construct_flags(ds: Dataset) -> list[Column]:
    """Candidate flags of the checks that every record passes when it is made."""
    is_, c = (lambda k: F.col("record_type") == k), F.col
    out: list[Column] = []
    if "eqr_quality_measure" in ds.kinds:
        m, n, d, r = is_("eqr_quality_measure"), c("numerator"), c("denominator"), c("rate")
        both = m & n.isNotNull() & d.isNotNull()
        out += [
            flag(F.lit("denominator is zero"), True, both & (d == 0)),
            flag(F.concat(F.lit("numerator ("), n, F.lit(") > denominator ("), d, F.lit(")")), True, both & (d != 0) & (n > d)),
            flag(F.concat(F.lit("percent rate out of [0,100]: "), r), True, m & (c("rate_unit") == "percent") & ~r.between(0.0, 100.0)),
        ]
    if "mmrc_finding" in ds.kinds:
        m, p = is_("mmrc_finding"), c("pct_preventable")
        out += [
            flag(F.concat(F.lit("pct_preventable out of [0,100]: "), p), True, m & ~p.between(0.0, 100.0)),
            flag(F.lit("negative mortality ratio"), True, m & (c("pregnancy_related_mortality_ratio") < 0)),
        ]
    for kind in ("waiver_1115_finding", "nursing_home_deficiency"):
        if kind in ds.kinds:
            y = c("report_year")
            out.append(flag(F.concat(F.lit("report_year out of range: "), y), True, is_(kind) & ~y.between(1990, 2035)))
    if "waiver_1115_finding" in ds.kinds:
        way = c("effect_direction")
        bad = E.blank_to_null(way).isNotNull() & ~F.lower(E.strip(way)).isin(*EFFECT_DIRECTIONS)
        out.append(flag(F.concat(F.lit("unrecognized effect_direction: "), way), False, is_("waiver_1115_finding") & bad))
    if "nursing_home_deficiency" in ds.kinds:
        s = c("scope_severity")
        out.append(flag(F.concat(F.lit("unrecognized scope_severity: "), s), False, is_("nursing_home_deficiency") & (s != "") & ~s.isin(*SCOPE_SEVERITY)))
    return out


def missing_required(ds: Dataset) -> Column:
    """Array of the names of required fields that are null in a record."""
    tests = [F.when((F.col("record_type") == k) & F.col(f).isNull(), F.lit(f)) for k in ds.kinds for f in KINDS[k].required]
    return F.filter(F.array(*tests).cast("array<string>"), lambda x: x.isNotNull())


def quarantine(records: DataFrame, ds: Dataset) -> tuple[DataFrame, DataFrame]:
    """(records with all required fields, the others with ``error``)."""
    bad = F.size(missing_required(ds)) > 0
    error = F.concat(F.lit("missing required: "), F.array_join(missing_required(ds), ", "))
    return records.where(~bad), records.where(bad).withColumn("error", error)


def parse_rules(docs: DataFrame, ds: Dataset) -> DataFrame:
    """Records of page-marked or plain canonical texts.

    ``docs`` has ``text``, ``ordinal`` and the document columns.  Header lines carry forward within a
    document; a section heading says which key-value lines become records.
    """
    rows = T.lines(docs.select("ordinal", *DOCUMENT, "text"))
    line, low = F.col("line"), F.lower("line")
    w = T.carried(["ordinal", "document_id"], "line_no")
    is_header = reduce(lambda a, b: a | b, [F.startswith(low, F.lit(p)) for p in ds.headers])
    is_section = F.startswith(line, F.lit("==")) & ~is_header
    heading = F.when(F.lit(False), "")
    for lay in ds.layouts:
        heading = heading.when(reduce(lambda a, b: a | b, [F.contains(F.upper(line), F.lit(h)) for h in lay.heading]), lay.kind)
    is_plan = F.lit(False)
    cols: dict[str, Column] = {"_section": T.carry(F.when(is_section, heading.otherwise("none")), w)}
    if ds.plan_lines:
        is_plan = F.startswith(low, F.lit("plan:")) & ~F.contains(line, F.lit("|")) & ~is_header & ~is_section
        cols["_plan"] = T.carry(F.when(is_plan, E.strip(F.substring(line, 6, 1 << 30))), w)
    defaults = ds.defaults()
    for prefix, name in ds.headers.items():
        value = T.header_value(line, prefix)
        if name == "year":
            value = T.header_year(value)
        elif name == "state" and ds.id == "eqr":
            value = F.upper(value)
        cols[f"_h_{name}"] = T.carry(value, w)
    body = rows.withColumns({**cols, "_skip": is_header | is_section | is_plan}).where(~F.col("_skip"))
    # generated, so that the map and the record are made once a line: a filter would be moved below them, with a copy of all that makes them
    body = body.select("*", F.explode(F.array(T.key_values(line, ds.key_pattern))).alias("_kv"))
    context = {n: F.coalesce(F.col(f"_h_{n}"), defaults[n]) if n in defaults else F.col(f"_h_{n}") for n in ds.headers.values()}
    seq = F.struct(F.col("ordinal").cast("long").alias("document"), F.col("line_no").cast("long").alias("item"), F.lit(0).alias("part"))
    made = None
    for lay in ds.layouts:  # a line is in one section, so at most one of the layouts makes a record of it
        has = reduce(lambda a, b: a | b, [F.map_contains_key("_kv", F.lit(n)) for n in lay.needs])
        here = (F.col("_section") == lay.kind) & has
        given: dict[str, Column] = {}
        for name, value in context.items():
            given["reporting_year" if name == "year" and ds.id == "eqr" else "report_year" if name == "year" else name] = value
        if ds.program == "program":
            given["program"] = context["program"]
        for f, (key, parser) in lay.fields.items():
            given[f] = parser(F.try_element_at("_kv", F.lit(key)))
        if ds.plan_lines:
            plan = E.first_of(F.try_element_at("_kv", F.lit("plan")), F.col("_plan"))
            here, given["plan_name"] = here & plan.isNotNull(), plan
        rec = _record(lay.kind, ds, given, seq, provenance("rule", ds.version, confidence=1.0))
        made = F.when(here, rec) if made is None else made.when(here, rec)
    return normalize(body.select(F.explode(F.array(made)).alias("r")).where("r is not null").select("r.*"), ds)


def salvage_json(text: Column) -> Column:
    """A model's answer as a variant; see ``answers.value``."""
    return answers.value(text)


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", "string")


def payload_records(payloads: DataFrame, ds: Dataset, method: str = "llm") -> DataFrame:
    """Records of payloads: ``payload`` (variant), ``chunk_index``, ``ordinal`` and the document columns.

    Items that are no objects are left out.  Numbers may be numbers or texts.  Where the payloads have a ``page_no``,
    that is the page of their items, whatever these say.
    """
    shown = [F.col("page_no").cast("int").alias("_page")] if "page_no" in payloads.columns else []
    get = lambda name: _text(F.col("payload"), name)
    base = payloads.select("ordinal", "chunk_index", *DOCUMENT, "payload", *shown)
    shared = ds.scalars(get)
    parts = []
    for number, (name, (kind, fields)) in enumerate(ds.lists.items()):
        items = F.try_variant_get("payload", f"$.{name}", "array<variant>")
        rows = base.select("*", F.posexplode(items).alias("_i", "_item"))
        rows = rows.where(F.startswith(F.schema_of_variant("_item"), F.lit("OBJECT")))
        item, flags = F.col("_item"), []
        given = dict(shared)
        for f, (key, parser) in fields.items():
            if f in ("rate", "rate_unit"):
                continue
            given[f] = parser(_text(item, key))
        if "rate" in fields:
            printed, named = _text(item, "rate"), F.lower(_text(item, "rate_unit"))
            numeric = F.schema_of_variant(F.try_variant_get(item, "$.rate", "variant")).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
            given["rate"] = F.when(numeric, F.try_variant_get(item, "$.rate", "double")).otherwise(E.rate_value(printed))
            given["rate_unit"] = F.when(named.isin(*E.RATE_UNITS), named).when(numeric | printed.isNull(), "percent").otherwise(E.rate_unit(printed))
        if kind == "eqr_quality_measure":
            year, report = given["reporting_year"], F.col("report_year")
            used = F.coalesce(F.nullif(year, F.lit(0)), F.nullif(report, F.lit(0)), F.lit(0))
            flags = year_flags(year, used, report)
            given["reporting_year"] = used
        elif "reporting_year" in fields:
            given["reporting_year"] = F.coalesce(F.nullif(given["reporting_year"], F.lit(0)), F.col("report_year"))
        seq = F.struct(F.col("ordinal").cast("long").alias("document"), (F.col("chunk_index") * 1_000_000 + F.col("_i")).cast("long").alias("item"), F.lit(number).alias("part"))
        page = F.col("_page") if shown else F.try_variant_get(item, "$.page", "int")
        prov = provenance(method, ds.version, page, F.try_variant_get(item, "$.confidence", "double"))
        raised = raise_flags(F.array().cast(FLAGS), flags) if flags else None
        parts.append(rows.select(_record(kind, ds, given, seq, prov, raised).alias("r")).select("r.*"))
    return normalize(reduce(DataFrame.unionByName, parts), ds)


#: What makes records, by the name that a run gives: the layouts of texts, or payloads of a model's answers with the
#: method that their records bear.
EXTRACTORS = {
    "rule": parse_rules,
    "payload": payload_records,
    "llm": payload_records,
    "llm_batch": payload_records,
    "vision": partial(payload_records, method="vision"),
    "vlm": partial(payload_records, method="vlm"),
    "openai": partial(payload_records, method="vlm"),
}


def extractor(name: str):
    """The function (rows, dataset) -> records of that name; ValueError for an unknown one.

    ``rule`` takes documents with their texts; the others take payloads: of chunks (``llm``, ``llm_batch``, ``vlm``, ``openai``)
    or of figure pages (``vision``, with ``page_no``).
    """
    if name not in EXTRACTORS:
        raise ValueError(f"unknown extractor {name!r}; known: {', '.join(sorted(EXTRACTORS))}")
    return EXTRACTORS[name]


def year_flags(read: Column, used: Column, report: Column) -> list[Column]:
    """Warnings about a measurement year, against the report's own year."""
    known = report.isNotNull() & (report != 0)
    defaulted = read.isNull() & known
    years = F.when(known & (used != 0) & ~defaulted, used)
    return [
        flag(F.concat(F.lit("reporting_year defaulted to publication year "), report, F.lit(" (no measurement year read) — verify against source")), False, defaulted),
        flag(F.concat(F.lit("reporting_year "), used, F.lit(" is after report year "), report, F.lit(" — likely parse error")), False, years > report),
        flag(F.concat(F.lit("reporting_year "), used, F.lit(" is implausibly far before report year "), report, F.lit(" — verify")), False, report - years > 8),
    ]


def route_results(results: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(payloads of succeeded results, dropped results with a reason), by custom_id of ``requests``."""
    joined = results.join(wanted.select("custom_id", "document_id", "chunk_index"), "custom_id", "left")
    lost = F.when(F.col("document_id").isNull(), "unmapped").when(F.col("status") != "succeeded", F.col("status"))
    joined = joined.withColumn("reason", lost)
    ok = joined.where("reason is null").withColumn("payload", salvage_json(F.col("answer"))).where("payload is not null")
    return ok.drop("reason", "answer", "status"), joined.where("reason is not null").select("custom_id", "reason")
