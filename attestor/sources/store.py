"""Small files and folders that driver and executors share, through the file system that Spark uses."""

from __future__ import annotations

import json
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _own_folder(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix=f"attestor-{application}-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI below the one that the cluster names in ``spark.checkpoint.dir``.

    Where that is unset a local master gets a temporary folder; elsewhere it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        root = _own_folder(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{name}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


class Folder:
    """JSON files in a folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path, self._jvm, self._gateway = path.rstrip("/"), spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names of the files, sorted; none where there is no folder."""
        if not self._fs.exists(self._at("")):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at("")) if not s.getPath().getName().startswith("."))

    def has(self, name: str) -> bool:
        """Whether a file or folder of the name is there."""
        return self._fs.exists(self._at(name))

    def read(self, name: str) -> dict | None:
        """A file's value; None where there is none."""
        if not self._fs.exists(self._at(name)):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def put(self, name: str, value: dict, replace: bool = False) -> bool:
        """Write a file so that readers see all of it or nothing; False where it is there already and stays.

        The value is written aside and renamed.  A rename onto a file that is there fails, so of two writers
        of one name one wins.
        """
        aside = self._at(f".{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()
        option = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._gateway.new_array(option, 1)
        how[0] = option.OVERWRITE if replace else option.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self._conf)
        try:
            context.rename(aside, self._at(name), how)
        except Exception:
            if replace or not self._fs.exists(self._at(name)):
                raise
            self._fs.delete(aside, False)
            return False
        return True

    def put_bytes(self, name: str, content: bytes) -> None:
        """Write a file of bytes, in place of one that is there."""
        stream = self._fs.create(self._at(name), True)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
