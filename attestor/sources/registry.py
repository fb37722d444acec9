"""Registries of datasets and sources: small YAML files that become DataFrames of candidates."""

from __future__ import annotations

import glob
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.functions.exprs import first_of
from attestor.functions.states import state_code
from attestor.plans.datasets import Dataset, dataset

CATALOG = (
    "id string, name string, description string, status string, priority int, issuer string, contents array<string>, "
    "existing_efforts array<struct<name:string,what:string,overlap:string>>, planned_records array<string>"
)
REPORT = "struct<year:int,title:string,url:string,local_path:string,state:string,program:string>"
ENTRY = (
    "ordinal int, state string, program string, eqro string, hospital string, committee string, facility string, evaluator string, "
    f"demonstration string, landing_url string, landing_max int, landing_keywords array<string>, reports array<{REPORT}>"
)
CANDIDATE = ("dataset_id", "url", "local_path", "title", "jurisdiction", "program", "publisher", "report_year")


def _yaml(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def _rows(items: list[dict], ddl: str, spark: SparkSession) -> DataFrame:
    from pyspark.sql.types import ArrayType, StructType

    schema = StructType.fromDDL(ddl)

    def fit(value, kind):
        if value is None:
            return None
        if isinstance(kind, StructType):
            return tuple(fit(value.get(f.name), f.dataType) for f in kind)
        if isinstance(kind, ArrayType):
            return [fit(v, kind.elementType) for v in value]
        return int(value) if kind.typeName() == "integer" else str(value)

    return spark.createDataFrame([fit(x, schema) for x in items], schema)


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The catalog of datasets; an absent list is empty."""
    return _rows(_yaml(path).get("datasets") or [], CATALOG, spark)


def dataset_meta(catalog: DataFrame, name: str) -> DataFrame:
    """(id, name) of one dataset; its id stands for a name that is missing."""
    found = catalog.where(F.col("id") == name).select("id", "name").limit(1)
    default = catalog.sparkSession.createDataFrame([(name,)], "id string")
    return default.join(found, "id", "left").select("id", F.coalesce("name", "id").alias("name"))


def load_sources(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """All source entries of ``sources_<name>*.yaml``, in the order of files and entries."""
    paths = sorted(p for p in glob.glob(os.path.join(folder, f"sources_{name}*.yaml")) if not p.endswith(".example"))
    items = [e for p in paths for e in _yaml(p).get("sources") or []]
    return _rows([{**e, "ordinal": i} for i, e in enumerate(items)], ENTRY, spark)


def discover(entries: DataFrame, ds: Dataset | str, limit: int | None = None) -> DataFrame:
    """Candidate documents: one row a report, what it doesn't say taken from its entry; at most ``limit``, in order."""
    ds = dataset(ds) if isinstance(ds, str) else ds
    rows = entries.select("*", F.posexplode("reports").alias("_n", "r"))
    program: Column = {"program": first_of(F.col("r.program"), F.col("program")), "demonstration": F.col("demonstration")}.get(ds.program, F.lit(None))
    out = rows.select(
        F.lit(ds.id).alias("dataset_id"), F.col("r.url").alias("url"), F.col("r.local_path").alias("local_path"), F.col("r.title").alias("title"),
        first_of(F.col("r.state"), F.col("state")).alias("jurisdiction"), program.cast("string").alias("program"),
        F.col(ds.publisher).alias("publisher"), F.col("r.year").alias("report_year"), F.struct("ordinal", "_n").alias("candidate_seq"),
    )
    out = out.withColumn("location", F.coalesce(first_of(F.col("url"), F.col("local_path")), F.lit("<unknown>")))
    return out.orderBy("candidate_seq").limit(limit) if limit else out


def landing_pages(entries: DataFrame, most: int = 3) -> DataFrame:
    """(ordinal, landing_url, keywords, most) of entries that name a landing page."""
    return entries.where(F.coalesce("landing_url", F.lit("")) != "").select("ordinal", "landing_url", "landing_keywords", F.coalesce("landing_max", F.lit(most)).alias("most"))


def new_entries(fresh: DataFrame, ds: Dataset | str, width: int = 120) -> DataFrame:
    """Registry entries (ordinal, state, hospital, facility, reports) of candidates that ``merge.new_sources`` found new.

    ``fresh`` has url, year, state (name or postal code), name and an order.  The family decides where the name goes:
    hospitals and facilities have it in their entry, other reports as their title.
    """
    ds = dataset(ds) if isinstance(ds, str) else ds
    name = F.substring(F.coalesce("name", F.lit("")), 1, width)
    own = ds.publisher if ds.publisher in ("hospital", "facility") else None
    report = F.struct(
        F.col("year").cast("int").alias("year"), (F.lit(None).cast("string") if own else name).alias("title"), F.trim("url").alias("url"),
        *[F.lit(None).cast("string").alias(c) for c in ("local_path", "state", "program")],
    )
    return fresh.select(
        F.col("ordinal"), F.coalesce(state_code(F.col("state")), F.col("state")).alias("state"),
        *[(name if own == c else F.lit(None).cast("string")).alias(c) for c in ("hospital", "facility")], F.array(report).alias("reports"),
    )


def write_entries(entries: DataFrame, ds: Dataset | str, folder: str) -> int:
    """Write ``sources_<name>.yaml`` of the entries, in order, and return how many; a file that was there is kept as ``.bak``.

    A registry is a file that people edit: its entries pass the driver one by one.
    """
    import yaml

    ds = dataset(ds) if isinstance(ds, str) else ds
    path = os.path.join(folder, f"sources_{ds.id}.yaml")
    known = lambda row: {k: v for k, v in row.asDict().items() if v is not None}
    items = []
    for r in entries.orderBy("ordinal").toLocalIterator():
        items.append({**{k: v for k, v in known(r).items() if k not in ("ordinal", "reports")}, "reports": [known(x) for x in r.reports]})
    if os.path.exists(path):
        os.replace(path, f"{path}.bak")
    with open(path, "w", encoding="utf-8") as f:
        f.write(f"# {ds.name}: sources found and not yet published\n")
        yaml.safe_dump({"sources": items}, f, sort_keys=False, allow_unicode=True, width=300)
    return len(items)
