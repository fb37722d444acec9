"""Domain axioms as columns: declarative checks of records and of groups of records.

A group axiom needs what its group says as a whole.  ``prepare`` adds that to the records by a partial aggregate
and a join in which nulls equal each other: rows of a hot group are combined before the shuffle, and the join
can split it, as no window ever gathers full rows of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.functions.exprs import all_same, strip


@dataclass(frozen=True)
class Axiom:
    """A rule: where it applies, what must hold there, and what to say where it doesn't."""

    name: str
    severity: str  # "hard" or "soft"
    applies: Column
    holds: Column
    detail: Column
    #: Adds columns that the three refer to; None where they need nothing but the record.
    prepare: Callable[[DataFrame], DataFrame] | None = None

    @property
    def outcome(self) -> Column:
        """True, false, or null where the axiom says nothing."""
        return F.when(self.applies, self.holds)


def prepared(records: DataFrame, axioms: Sequence[Axiom]) -> DataFrame:
    """The records with what group axioms need to know of their groups."""
    for a in axioms:
        records = a.prepare(records) if a.prepare else records
    return records


def of_group(here: Column, by: Sequence[str | Column], facts: dict[str, Column], kept: Column | None = None) -> Callable[[DataFrame], DataFrame]:
    """A ``prepare`` that adds ``facts``, aggregates over the rows of ``here`` in a group, to these rows.

    Groups for which ``kept`` (of the facts) is not true are left out before the join; their rows get nulls, as
    do rows that are not ``here``.
    """
    columns = [F.col(b) if isinstance(b, str) else b for b in by]

    def prepare(records: DataFrame) -> DataFrame:
        tag = "_".join(facts)
        keys = [f"_g{i}_{tag}" for i in range(len(columns))]
        groups = records.where(here).groupBy(*[c.alias(k) for k, c in zip(keys, columns, strict=True)]).agg(*[v.alias(n) for n, v in facts.items()])
        groups = groups if kept is None else groups.where(kept)
        groups = groups.withColumn(f"_h_{tag}", F.xxhash64(*keys))
        # rows are sorted and matched by one hash; that the groups are equal is then looked at
        cond = here & (F.xxhash64(*columns) == F.col(f"_h_{tag}")) & all_same(columns, [F.col(k) for k in keys])
        return records.join(groups, cond, "left").drop(f"_h_{tag}", *keys)

    return prepare


def duplicate_grain(here: Column, grain: Sequence[str | Column], message: str) -> Axiom:
    """Each row of ``here`` must be alone in its grain; nulls in the grain equal each other."""
    n = F.col("_grain_rows")
    prepare = of_group(here, grain, {"_grain_rows": F.count(F.lit(1))}, F.col("_grain_rows") > 1)
    return Axiom("duplicate_grain", "soft", here & n.isNotNull(), F.lit(False), F.concat(F.lit(f"{message} (x"), n, F.lit(")")), prepare)


def subgroup_within_overall(here: Column, by: Sequence[str], group: str, amount: str, overall: Sequence[str]) -> Axiom:
    """No subgroup's amount exceeds the first overall row's, nor does the sum of all other rows."""
    value = F.col(amount)
    counted = here & value.isNotNull()
    named = F.lower(strip(F.coalesce(F.col(group), F.lit("")))).isin(*overall)
    facts = {"_overall": F.min(F.when(named, F.struct("record_seq", value.alias("v")))), "_amounts": F.sum(value)}
    prepare = of_group(counted, by, facts, F.col("_overall").isNotNull())
    first = F.col("_overall")
    mine = first["record_seq"] == F.col("record_seq")
    holds = F.when(mine, F.col("_amounts") - first["v"] <= first["v"]).otherwise(value <= first["v"])
    detail = F.when(mine, "sum of subgroup deaths exceeds overall").otherwise(
        F.concat(F.lit("subgroup deaths "), value, F.lit(" exceed overall "), first["v"])
    )
    return Axiom("subgroup_le_overall", "soft", counted & first.isNotNull() & ~holds, F.lit(False), detail, prepare)
