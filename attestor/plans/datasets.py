"""The five dataset families, declared: record kinds, identities, layouts, payload maps and axioms.

Nothing here runs per row: layouts and payload maps name columns, axioms are Column expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestor.functions import exprs as E
from attestor.operators.constraints import Axiom, duplicate_grain, subgroup_within_overall

# Vocabularies of the record kinds.
EFFECT_DIRECTIONS = ("improved", "no significant change", "worsened", "mixed", "not estimated", "descriptive")
SCOPE_SEVERITY = tuple("ABCDEFGHIJKL")
OVERALL_GROUPS = ("overall", "total", "")


@dataclass(frozen=True)
class Kind:
    """A record kind: its table and its own fields with types, required ones first named in ``required``."""

    name: str
    table: str
    fields: dict[str, str]
    required: tuple[str, ...]
    defaults: dict[str, str] = field(default_factory=dict)
    upper_state: bool = False
    strip_state: bool = False


# Names, types and required fields of the record kinds.
KINDS = {
    k.name: k
    for k in (
        Kind(
            "eqr_quality_measure", "eqr_quality_measures",
            {
                "state": "string",
                "program": "string",
                "plan_name": "string",
                "plan_id": "string",
                "measure_name": "string",
                "measure_steward": "string",
                "measure_code": "string",
                "reporting_year": "int",
                "rate": "double",
                "rate_unit": "string",
                "numerator": "int",
                "denominator": "int",
                "population": "string",
                "data_collection_method": "string",
            },
            ("state", "plan_name", "measure_name", "reporting_year"), defaults={"measure_steward": "Unknown", "rate_unit": "percent"}, upper_state=True,
        ),
        Kind(
            "eqr_pip", "eqr_performance_improvement_projects",
            {
                "state": "string",
                "program": "string",
                "plan_name": "string",
                "pip_title": "string",
                "clinical_focus_area": "string",
                "reporting_year": "int",
                "baseline_rate": "double",
                "goal_rate": "double",
                "most_recent_rate": "double",
                "validation_status": "string",
            },
            ("state", "plan_name", "pip_title"), upper_state=True,
        ),
        Kind(
            "eqr_compliance", "eqr_compliance_findings",
            {
                "state": "string",
                "program": "string",
                "plan_name": "string",
                "standard_area": "string",
                "determination": "string",
                "reporting_year": "int",
            },
            ("state", "plan_name", "standard_area"), upper_state=True,
        ),
        Kind(
            "chna_need", "chna_identified_needs",
            {
                "hospital_name": "string",
                "hospital_ein": "string",
                "state": "string",
                "report_year": "int",
                "need": "string",
                "domain": "string",
                "is_priority": "boolean",
                "priority_rank": "int",
            },
            ("hospital_name", "need"),
        ),
        Kind(
            "chna_strategy", "chna_implementation_strategies",
            {
                "hospital_name": "string",
                "state": "string",
                "report_year": "int",
                "need_addressed": "string",
                "strategy": "string",
                "measurable_objective": "string",
            },
            ("hospital_name", "strategy"),
        ),
        Kind(
            "mmrc_finding", "mmrc_findings",
            {
                "state": "string",
                "report_period": "string",
                "population_group": "string",
                "pregnancy_related_deaths": "int",
                "pregnancy_related_mortality_ratio": "double",
                "pct_preventable": "double",
                "leading_cause": "string",
            },
            ("state",), strip_state=True,
        ),
        Kind(
            "mmrc_recommendation", "mmrc_recommendations",
            {
                "state": "string",
                "report_year": "int",
                "recommendation": "string",
                "category": "string",
                "target_level": "string",
            },
            ("state", "recommendation"), strip_state=True,
        ),
        Kind(
            "waiver_1115_finding", "waiver_1115_findings",
            {
                "state": "string",
                "demonstration_name": "string",
                "waiver_id": "string",
                "report_year": "int",
                "evaluation_period": "string",
                "evaluator": "string",
                "intervention": "string",
                "domain": "string",
                "outcome_measure": "string",
                "population": "string",
                "effect_direction": "string",
                "value": "double",
                "value_unit": "string",
                "significance": "string",
                "result": "string",
            },
            ("state", "demonstration_name"), strip_state=True,
        ),
        Kind(
            "waiver_1115_recommendation", "waiver_1115_recommendations",
            {
                "state": "string",
                "demonstration_name": "string",
                "report_year": "int",
                "recommendation": "string",
                "category": "string",
            },
            ("state", "recommendation"), strip_state=True,
        ),
        Kind(
            "nursing_home_deficiency", "nursing_home_deficiencies",
            {
                "facility_name": "string",
                "ccn": "string",
                "state": "string",
                "survey_date": "string",
                "report_year": "int",
                "ftag": "string",
                "ftag_description": "string",
                "scope_severity": "string",
                "deficiency_description": "string",
            },
            ("facility_name", "state"), upper_state=True,
        ),
        Kind(
            "nursing_home_poc", "nursing_home_plans_of_correction",
            {
                "facility_name": "string",
                "state": "string",
                "report_year": "int",
                "ftag": "string",
                "correction": "string",
                "completion_date": "string",
            },
            ("facility_name", "state", "correction"), upper_state=True,
        ),
    )
}

#: Every field of every kind; records of one dataset share one wide table.
TEXT = E.strip


@dataclass(frozen=True)
class Layout:
    """One section of a canonical text: which lines become records, and how keys become fields."""

    kind: str
    heading: tuple[str, ...]
    needs: tuple[str, ...]
    fields: dict[str, tuple[str, Callable[[Column], Column]]]


@dataclass(frozen=True)
class Dataset:
    """All that differs between dataset families."""

    id: str
    name: str
    kinds: tuple[str, ...]
    identity: tuple[str, ...]
    ensemble_kind: str
    ensemble_key: tuple[str, ...]
    ensemble_fields: tuple[str, ...]
    publisher: str  # the registry key that names a source's publisher
    headers: dict[str, str]  # header prefix -> carried field
    defaults: Callable[[], dict[str, Column]]  # carried field -> value where no header was seen, from document columns
    layouts: tuple[Layout, ...]
    lists: dict[str, tuple[str, dict[str, tuple[str, Callable[[Column], Column]]]]]  # payload list -> kind, fields
    scalars: Callable[[Callable[[str], Column]], dict[str, Column]]  # payload scalars -> fields shared by all items
    axioms: Callable[[], tuple[Axiom, ...]]
    key_pattern: str = r"([A-Za-z /\-]+):\s*([^|]+)"
    program: str | None = "program"
    plan_lines: bool = False
    version: str = "0.1.0"


def AS_IS(x: Column) -> Column:  # noqa: N802
    """The text itself."""
    return x


def _is(kind: str) -> Column:
    return F.col("record_type") == kind


def _eqr_axioms() -> tuple[Axiom, ...]:
    here, n, d, r = _is("eqr_quality_measure"), F.col("numerator"), F.col("denominator"), F.col("rate")
    percent = here & r.isNotNull() & (F.col("rate_unit") == "percent")
    implied = 100.0 * n / F.nullif(d, F.lit(0))
    return (
        Axiom("num_le_den", "hard", here & n.isNotNull() & d.isNotNull(), n <= d, F.concat(F.lit("numerator "), n, F.lit(" exceeds denominator "), d)),
        Axiom("denominator_positive", "hard", here & d.isNotNull(), d > 0, F.lit("denominator is zero")),
        Axiom("percent_in_range", "hard", percent, r.between(0.0, 100.0), F.concat(F.lit("percent rate outside [0,100]: "), r)),
        Axiom(
            "rate_matches_ratio", "soft", percent & n.isNotNull() & d.isNotNull() & (d != 0), F.abs(implied - r) <= 1.0,
            F.concat(F.lit("printed rate "), r, F.lit(" disagrees with implied "), F.format_string("%.1f", implied)),
        ),
        duplicate_grain(here, ("state", "plan_name", "measure_name", "population", "reporting_year"), "duplicate analytic grain"),
    )


def _chna_axioms() -> tuple[Axiom, ...]:
    ranked = _is("chna_need") & F.col("priority_rank").isNotNull()
    return (
        Axiom("priority_rank_positive", "soft", ranked, F.col("priority_rank") > 0, F.concat(F.lit("non-positive priority rank: "), F.col("priority_rank"))),
        Axiom("rank_implies_priority", "soft", ranked & F.col("is_priority").isNotNull(), F.col("is_priority"), F.lit("need has a priority rank but is marked non-priority")),
    )


def _mmrc_axioms() -> tuple[Axiom, ...]:
    here, pct, ratio = _is("mmrc_finding"), F.col("pct_preventable"), F.col("pregnancy_related_mortality_ratio")
    return (
        Axiom("pct_preventable_in_range", "hard", here & pct.isNotNull(), pct.between(0.0, 100.0), F.concat(F.lit("pct_preventable outside [0,100]: "), pct)),
        Axiom("mortality_ratio_nonnegative", "hard", here & ratio.isNotNull(), ratio >= 0, F.lit("negative mortality ratio")),
        subgroup_within_overall(here, ("state",), "population_group", "pregnancy_related_deaths", OVERALL_GROUPS),
    )


def _waiver_axioms() -> tuple[Axiom, ...]:
    here, way = _is("waiver_1115_finding"), F.col("effect_direction")
    return (
        Axiom("known_effect_direction", "soft", here & E.blank_to_null(way).isNotNull(), F.lower(TEXT(way)).isin(*EFFECT_DIRECTIONS), F.concat(F.lit("unrecognized effect_direction: "), way)),
        duplicate_grain(here, ("state", "demonstration_name", "intervention", "outcome_measure", "population", "report_year"), "duplicate finding grain"),
    )


def _nursing_axioms() -> tuple[Axiom, ...]:
    here, letter = _is("nursing_home_deficiency"), F.col("scope_severity")
    return (
        Axiom("valid_scope_severity", "soft", here & E.blank_to_null(letter).isNotNull(), F.upper(TEXT(letter)).isin(*SCOPE_SEVERITY), F.concat(F.lit("scope_severity not a valid A-L letter: "), letter)),
        duplicate_grain(here, ("state", F.coalesce(E.blank_to_null(F.col("ccn")), F.col("facility_name")), "ftag", "report_year"), "duplicate deficiency grain"),
    )


_doc = F.col


def _year(get: Callable[[str], Column]) -> Column:
    return F.coalesce(F.nullif(E.to_int(get("report_year")), F.lit(0)), _doc("report_year"))


def _not_placeholder(x: Column) -> Column:
    t = TEXT(x)
    return F.when((t != "") & (F.upper(t) != "<UNKNOWN>"), t)


# Headers, section headings, keys and payload names of the canonical texts.
DATASETS = {
    d.id: d
    for d in (
        Dataset(
            "eqr", "Medicaid external quality review technical reports", ("eqr_quality_measure", "eqr_pip", "eqr_compliance"),
            ("state", "plan_name", "measure_name", "population", "reporting_year"), "eqr_quality_measure",
            ("state", "plan_name", "measure_name", "population", "reporting_year"), ("rate", "numerator", "denominator", "measure_steward"),
            "eqro", {"state:": "state", "program:": "program", "reporting year:": "year"},
            lambda: {"state": F.upper(E.first_of(_doc("jurisdiction"), F.lit("ZZ"))), "program": _doc("program"), "year": F.coalesce(_doc("report_year"), F.lit(0))},
            (
                Layout("eqr_quality_measure", ("PERFORMANCE MEASURE",), ("measure",), {
                    "measure_name": ("measure", AS_IS),
                    "measure_steward": ("steward", E.steward),
                    "measure_code": ("code", AS_IS),
                    "rate": ("rate", E.rate_value),
                    "rate_unit": ("rate", E.rate_unit),
                    "numerator": ("numerator", E.to_int),
                    "denominator": ("denominator", E.to_int),
                    "population": ("population", AS_IS),
                    "data_collection_method": ("method", AS_IS),
                }),
                Layout("eqr_pip", ("IMPROVEMENT PROJECT",), ("title",), {
                    "pip_title": ("title", AS_IS),
                    "clinical_focus_area": ("focus", AS_IS),
                    "baseline_rate": ("baseline", E.rate_value),
                    "goal_rate": ("goal", E.rate_value),
                    "most_recent_rate": ("most recent", E.rate_value),
                    "validation_status": ("validation", AS_IS),
                }),
                Layout("eqr_compliance", ("COMPLIANCE",), ("standard",), {
                    "standard_area": ("standard", AS_IS),
                    "determination": ("determination", AS_IS),
                }),
            ),
            {
                "quality_measures": ("eqr_quality_measure", {
                    "plan_name": ("plan_name", TEXT),
                    "measure_name": ("measure_name", TEXT),
                    "measure_steward": ("measure_steward", E.steward),
                    "measure_code": ("measure_code", AS_IS),
                    "reporting_year": ("reporting_year", E.to_int),
                    "rate": ("rate", AS_IS),
                    "rate_unit": ("rate_unit", AS_IS),
                    "numerator": ("numerator", E.to_int),
                    "denominator": ("denominator", E.to_int),
                    "population": ("population", AS_IS),
                    "data_collection_method": ("data_collection_method", AS_IS),
                }),
                "performance_improvement_projects": ("eqr_pip", {
                    "plan_name": ("plan_name", TEXT),
                    "pip_title": ("pip_title", TEXT),
                    "clinical_focus_area": ("clinical_focus_area", AS_IS),
                    "reporting_year": ("reporting_year", E.to_int),
                    "baseline_rate": ("baseline_rate", E.rate_value),
                    "goal_rate": ("goal_rate", E.rate_value),
                    "most_recent_rate": ("most_recent_rate", E.rate_value),
                    "validation_status": ("validation_status", AS_IS),
                }),
                "compliance_findings": ("eqr_compliance", {
                    "plan_name": ("plan_name", TEXT),
                    "standard_area": ("standard_area", TEXT),
                    "determination": ("determination", AS_IS),
                    "reporting_year": ("reporting_year", E.to_int),
                }),
            },
            lambda get: {"state": E.first_of(F.upper(TEXT(E.first_of(_doc("jurisdiction"), get("state")))), F.lit("ZZ")), "program": E.first_of(get("program"), _doc("program"))},
            _eqr_axioms, key_pattern=r"([A-Za-z /]+):\s*([^|]+)", plan_lines=True,
        ),
        Dataset(
            "chna", "Hospital community health needs assessments", ("chna_need", "chna_strategy"),
            ("state", "hospital_name", "need", "report_year"), "chna_need", ("hospital_name", "need", "report_year"),
            ("domain", "is_priority", "priority_rank"), "hospital",
            {"hospital:": "hospital_name", "ein:": "hospital_ein", "state:": "state", "report year:": "year"},
            lambda: {"hospital_name": E.first_of(_doc("publisher"), F.lit("Unknown")), "state": _doc("jurisdiction"), "year": _doc("report_year"), "hospital_ein": F.lit(None).cast("string")},
            (
                Layout("chna_need", ("IDENTIFIED NEED",), ("need",), {
                    "need": ("need", AS_IS),
                    "domain": ("domain", AS_IS),
                    "is_priority": ("priority", E.to_bool),
                    "priority_rank": ("rank", E.to_int),
                }),
                Layout("chna_strategy", ("IMPLEMENTATION", "STRATEG"), ("strategy",), {
                    "need_addressed": ("need", AS_IS),
                    "strategy": ("strategy", AS_IS),
                    "measurable_objective": ("objective", AS_IS),
                }),
            ),
            {
                "identified_needs": ("chna_need", {
                    "need": ("need", TEXT),
                    "domain": ("domain", AS_IS),
                    "is_priority": ("is_priority", lambda x: x.try_cast("boolean")),
                    "priority_rank": ("priority_rank", E.to_int),
                }),
                "implementation_strategies": ("chna_strategy", {
                    "need_addressed": ("need_addressed", AS_IS),
                    "strategy": ("strategy", TEXT),
                    "measurable_objective": ("measurable_objective", AS_IS),
                }),
            },
            lambda get: {"hospital_name": F.coalesce(_not_placeholder(get("hospital_name")), E.first_of(_doc("publisher"), F.lit("Unknown"))), "hospital_ein": get("hospital_ein"), "state": E.first_of(_doc("jurisdiction"), get("state")), "report_year": _year(get)},
            _chna_axioms, key_pattern=r"([A-Za-z /]+):\s*([^|]+)", program=None,
        ),
        Dataset(
            "mmrc", "Maternal mortality review committee reports", ("mmrc_finding", "mmrc_recommendation"),
            ("state", "population_group", "report_period"), "mmrc_finding", ("state", "population_group", "report_period"),
            ("pregnancy_related_deaths", "pregnancy_related_mortality_ratio", "pct_preventable"), "committee",
            {"state:": "state", "report period:": "report_period", "report year:": "year"},
            lambda: {"state": E.first_of(_doc("jurisdiction"), F.lit("Unknown")), "report_period": F.lit(None).cast("string"), "year": _doc("report_year")},
            (
                Layout("mmrc_finding", ("FINDING",), ("group", "pregnancy-related deaths"), {
                    "population_group": ("group", AS_IS),
                    "pregnancy_related_deaths": ("pregnancy-related deaths", E.to_int),
                    "pregnancy_related_mortality_ratio": ("ratio", E.to_float),
                    "pct_preventable": ("preventable", E.to_float),
                    "leading_cause": ("leading cause", AS_IS),
                }),
                Layout("mmrc_recommendation", ("RECOMMENDATION",), ("recommendation",), {
                    "recommendation": ("recommendation", AS_IS),
                    "category": ("category", AS_IS),
                    "target_level": ("target", AS_IS),
                }),
            ),
            {
                "findings": ("mmrc_finding", {
                    "population_group": ("population_group", AS_IS),
                    "pregnancy_related_deaths": ("pregnancy_related_deaths", E.to_int),
                    "pregnancy_related_mortality_ratio": ("pregnancy_related_mortality_ratio", E.to_float),
                    "pct_preventable": ("pct_preventable", E.to_float),
                    "leading_cause": ("leading_cause", AS_IS),
                }),
                "recommendations": ("mmrc_recommendation", {
                    "recommendation": ("recommendation", TEXT),
                    "category": ("category", AS_IS),
                    "target_level": ("target_level", AS_IS),
                }),
            },
            lambda get: {"state": E.first_of(_doc("jurisdiction"), get("state"), F.lit("Unknown")), "report_period": get("report_period"), "report_year": _year(get)},
            _mmrc_axioms, program=None,
        ),
        Dataset(
            "waiver_1115", "Section 1115 demonstration evaluation reports", ("waiver_1115_finding", "waiver_1115_recommendation"),
            ("state", "demonstration_name", "intervention", "outcome_measure", "population", "report_year"), "waiver_1115_finding",
            ("state", "demonstration_name", "intervention", "outcome_measure", "population", "report_year"), ("effect_direction", "value", "outcome_measure"),
            "evaluator",
            {"state:": "state", "demonstration:": "demonstration_name", "report year:": "year", "evaluation period:": "evaluation_period", "evaluator:": "evaluator"},
            lambda: {
                "state": E.first_of(_doc("jurisdiction"), F.lit("Unknown")), "demonstration_name": E.first_of(_doc("program"), F.lit("Unknown demonstration")),
                "year": _doc("report_year"), "evaluation_period": F.lit(None).cast("string"), "evaluator": _doc("publisher"),
            },
            (
                Layout("waiver_1115_finding", ("FINDING",), ("outcome", "intervention"), {
                    "intervention": ("intervention", AS_IS),
                    "domain": ("domain", AS_IS),
                    "outcome_measure": ("outcome", AS_IS),
                    "population": ("population", AS_IS),
                    "effect_direction": ("direction", AS_IS),
                    "value": ("value", E.to_float),
                    "value_unit": ("unit", AS_IS),
                    "significance": ("significance", AS_IS),
                    "result": ("result", AS_IS),
                }),
                Layout("waiver_1115_recommendation", ("RECOMMENDATION",), ("recommendation",), {
                    "recommendation": ("recommendation", AS_IS),
                    "category": ("category", AS_IS),
                }),
            ),
            {
                "findings": ("waiver_1115_finding", {
                    "intervention": ("intervention", AS_IS),
                    "domain": ("domain", AS_IS),
                    "outcome_measure": ("outcome_measure", AS_IS),
                    "population": ("population", AS_IS),
                    "effect_direction": ("effect_direction", AS_IS),
                    "value": ("value", E.to_float),
                    "value_unit": ("value_unit", AS_IS),
                    "significance": ("significance", AS_IS),
                    "result": ("result", AS_IS),
                }),
                "recommendations": ("waiver_1115_recommendation", {
                    "recommendation": ("recommendation", TEXT),
                    "category": ("category", AS_IS),
                }),
            },
            lambda get: {
                "state": E.first_of(_doc("jurisdiction"), get("state"), F.lit("Unknown")),
                "demonstration_name": E.first_of(get("demonstration_name"), _doc("program"), F.lit("Unknown demonstration")),
                "waiver_id": get("waiver_id"), "report_year": _year(get), "evaluation_period": get("evaluation_period"),
                "evaluator": E.first_of(get("evaluator"), _doc("publisher")),
            },
            _waiver_axioms, program="demonstration",
        ),
        Dataset(
            "nursing_home_2567", "Nursing home statements of deficiencies", ("nursing_home_deficiency", "nursing_home_poc"),
            ("state", "ccn", "facility_name", "ftag", "report_year"), "nursing_home_deficiency", ("state", "ccn_or_facility", "ftag", "report_year"),
            ("ftag", "scope_severity", "ftag_description"), "facility",
            {"facility:": "facility_name", "ccn:": "ccn", "state:": "state", "survey date:": "survey_date", "report year:": "year"},
            lambda: {
                "facility_name": E.first_of(_doc("publisher"), F.lit("Unknown facility")), "state": E.first_of(_doc("jurisdiction"), F.lit("Unknown")),
                "ccn": F.lit(None).cast("string"), "survey_date": F.lit(None).cast("string"), "year": _doc("report_year"),
            },
            (
                Layout("nursing_home_deficiency", ("DEFICIENC",), ("f-tag", "finding"), {
                    "ftag": ("f-tag", AS_IS),
                    "ftag_description": ("description", AS_IS),
                    "scope_severity": ("scope/severity", AS_IS),
                    "deficiency_description": ("finding", AS_IS),
                }),
                Layout("nursing_home_poc", ("CORRECTION",), ("correction",), {
                    "ftag": ("tag", AS_IS),
                    "correction": ("correction", AS_IS),
                    "completion_date": ("completion", AS_IS),
                }),
            ),
            {
                "deficiencies": ("nursing_home_deficiency", {
                    "ftag": ("ftag", AS_IS),
                    "ftag_description": ("ftag_description", AS_IS),
                    "scope_severity": ("scope_severity", AS_IS),
                    "deficiency_description": ("deficiency_description", AS_IS),
                }),
                "plans_of_correction": ("nursing_home_poc", {
                    "ftag": ("ftag", AS_IS),
                    "correction": ("correction", lambda x: TEXT(F.coalesce(x, F.lit("")))),
                    "completion_date": ("completion_date", AS_IS),
                }),
            },
            lambda get: {
                "facility_name": E.first_of(get("facility_name"), _doc("publisher"), F.lit("Unknown facility")),
                "state": E.first_of(_doc("jurisdiction"), get("state"), F.lit("Unknown")), "ccn": get("ccn"), "survey_date": get("survey_date"), "report_year": _year(get),
            },
            _nursing_axioms, program=None,
        ),
    )
}


def dataset(name: str) -> Dataset:
    """The dataset family of that id."""
    try:
        return DATASETS[name]
    except KeyError:
        raise KeyError(f"unknown dataset {name!r}; known: {', '.join(sorted(DATASETS))}") from None
