"""A release that is merged copy-on-write: documents hashed to buckets, touched buckets rewritten, a log committed last.

``<path>/data/<commit>/bucket=<k>`` holds rows, ``<path>/log/<version>`` names for every bucket the commits whose rows
are its present ones.  A merge reads and writes only the buckets of the documents it replaces, then puts the next
log file, which one writer alone can do.  What a failed merge wrote is named by no log and thus never read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from attestor.sources.store import Folder

BUCKETS = 64


class Conflict(RuntimeError):
    """Another writer committed first."""


@dataclass
class Version:
    """What a log file says."""

    number: int = -1
    buckets: dict[str, list[str]] = field(default_factory=dict)  # bucket -> commits
    schema: str | None = None
    batches: dict[str, int] = field(default_factory=dict)  # writer -> its last batch
    n_buckets: int = BUCKETS


class ReleaseTable:
    """Rows by document; ``key`` names the document id."""

    def __init__(self, spark: SparkSession, path: str, key: str = "document_id", n_buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.key, self.n_buckets = spark, path.rstrip("/"), key, n_buckets
        self._log, self._aside = Folder(spark, f"{self.path}/log"), []

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(n)).cast("int")

    def version(self, number: int | None = None) -> Version:
        """The newest version, or that of a number; an empty one where nothing was committed."""
        names = self._log.names()
        if number is None and not names:
            return Version(n_buckets=self.n_buckets)
        name = names[-1] if number is None else f"{number:012d}.json"
        said = self._log.read(name)
        if said is None:
            raise ValueError(f"{self.path}: no version {number}")
        return Version(**said)

    def _read(self, v: Version, buckets: list[str]) -> DataFrame:
        paths = [f"{self.path}/data/{c}/bucket={b}" for b in buckets for c in v.buckets.get(b, [])]
        schema = StructType.fromJson(json.loads(v.schema)) if v.schema else StructType()
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, number: int | None = None) -> DataFrame:
        """All rows of a version, the newest by default."""
        v = self.version(number)
        return self._read(v, sorted(v.buckets))

    def merge(self, rows: DataFrame, documents: DataFrame, writer: str = "", batch: int | None = None) -> Version:
        """Replace the rows of ``documents`` by ``rows`` and return the version that has them.

        A document without rows loses those it had.  Rows of other documents than these are replaced as well
        where they come.  A batch of a writer that was merged before, or an earlier one, changes nothing; numbers
        may be skipped.
        """
        was = self.version()
        if batch is not None and was.batches.get(writer, -1) >= batch:
            return was
        ids = documents.select(self.key).union(rows.select(self.key)).distinct()
        touched = self._buckets_of(ids, was)
        old = self._read(was, touched)
        kept = old.join(ids.withColumnRenamed(self.key, "_id"), F.col(self.key).eqNullSafe(F.col("_id")), "left_anti") if old.columns else None
        new = rows if kept is None else kept.unionByName(rows, allowMissingColumns=True)
        return self._commit(was, new, {b: [] for b in touched}, {writer: batch} if batch is not None else {})

    def append(self, rows: DataFrame) -> Version:
        """Add rows to those that are there, of which none is read or written."""
        return self._commit(self.version(), rows, {}, {})

    def staged(self, rows: DataFrame) -> DataFrame:
        """Write rows aside in the table's folder and return a reader of them; for rows that are dear to make and read twice."""
        name = uuid.uuid4().hex
        self._aside.append(name)
        rows.write.parquet(f"{self.path}/aside/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/aside/{name}")

    def clear(self) -> None:
        """Delete what this object has staged."""
        while self._aside:
            Folder(self.spark, f"{self.path}/aside").remove(self._aside.pop())

    def _buckets_of(self, rows: DataFrame, v: Version) -> list[str]:
        found = rows.select(self._bucket(v.n_buckets).alias("b")).distinct().collect()  # at most n_buckets
        return sorted(str(r.b) for r in found)

    def _commit(self, was: Version, new: DataFrame, without: dict[str, list[str]], batch: dict[str, int]) -> Version:
        commit = uuid.uuid4().hex
        # partitions of a large bucket are split, small ones put together
        new.withColumn("bucket", self._bucket(was.n_buckets)).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{commit}")
        buckets = was.buckets | without
        for name in Folder(self.spark, f"{self.path}/data/{commit}").names():
            b = name.partition("bucket=")[2]
            if b:
                buckets[b] = [*buckets.get(b, []), commit]
        known = StructType.fromJson(json.loads(was.schema)) if was.schema else StructType()
        names = {f.name for f in new.schema.fields}
        schema = StructType([*new.schema.fields, *(f for f in known.fields if f.name not in names)])
        now = Version(was.number + 1, buckets, schema.json(), was.batches | batch, was.n_buckets)
        if not self._log.put(f"{now.number:012d}.json", now.__dict__):
            raise Conflict(f"{self.path}: version {now.number} was committed by another writer")
        return now

    def unread(self, keep: int = 1) -> list[str]:
        """Commits that none of the last ``keep`` versions names; their folders can be deleted once nothing reads them."""
        named = set()
        for name in self._log.names()[-keep:]:
            named |= {c for commits in Version(**self._log.read(name)).buckets.values() for c in commits}
        return [c for c in Folder(self.spark, f"{self.path}/data").names() if c not in named]

    def vacuum(self, keep: int = 1) -> int:
        """Delete what ``unread`` names; returns how many commits went."""
        gone, data = self.unread(keep), Folder(self.spark, f"{self.path}/data")
        for c in gone:
            data.remove(c)
        return len(gone)
