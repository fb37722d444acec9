"""Tables that cut lineage, in the folder all executors share.

The folder is the one that the cluster names in ``spark.checkpoint.dir``.  Only on one machine
(``local[...]``), where that is unset, a folder of this module's own is used; on a cluster it is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_dir(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix=f"attestor-{application}-")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder's URI."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
    return _own_dir(spark.sparkContext.applicationId)


#: Rows of a few numbers from which a table that tells its size is written by a further task.
FILE_ROWS = 100_000


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return a reader of it.

    A lost executor then costs a read, not a recomputation.  Each call has a folder of its own, named
    by application, so reruns never meet old files and an operator can clear them by application.
    ``rows``, which the table won't pass by much, lets few rows be written by few tasks, one a core at least,
    whatever the number of shuffle partitions.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, rows // FILE_ROWS))
    path = f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing unfinished reads any more."""
    for df in tables:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if f"/tables/{spark.sparkContext.applicationId}/" in path:
                where = spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
