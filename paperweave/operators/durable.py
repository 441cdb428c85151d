"""Cutting lineage with tables in the cluster's shared folder.

Iterative operators write each round as parquet below the folder named in ``spark.checkpoint.dir``
and read it back. The files outlive executors, keep statistics for AQE, and are columnar, so they
take less disk than RDD checkpoints. Only where the setting is unset on a single machine (tests) a
local temporary folder is made; on a cluster that is an error. What a session wrote is deleted when the
driver ends; long sessions may call ``clean`` once their results are written.
"""

from __future__ import annotations

import atexit
import itertools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_number = itertools.count()


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables that must survive the loss of executors."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="paperweave-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_roots: set[str] = set()


def clean(spark: SparkSession) -> None:
    """Deletes the tables of all operator runs of this driver; results that still read them must be written before."""
    while _roots:
        _delete(spark, _roots.pop())


def _clean_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _roots:
        try:
            clean(spark)
        except Exception:  # noqa: BLE001  the session may be gone already
            pass


atexit.register(_clean_at_exit)


class Scratch:
    """Tables of one operator run below the shared folder."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        _roots.add(self.root)

    def keep(self, df: DataFrame, label: str = "t") -> DataFrame:
        """Write ``df`` once and return the table that was written."""
        path = f"{self.root}/{next(_number)}-{label}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a kept table that no later stage reads."""
        files = df.inputFiles()
        if files:
            _delete(self.spark, files[0].rsplit("/", 1)[0])
