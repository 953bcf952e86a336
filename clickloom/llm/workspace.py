"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or in a local session without one the warehouse folder.

    On a cluster the warehouse may be a folder of each machine, so there the setting is
    required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or spark.conf.get("spark.sql.warehouse.dir")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once an application.

    The archive is made in the driver's own folder; Spark itself takes it to executors.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix=f"{package.name}-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        code = Path(folder) / "code" / package.name
        shutil.copytree(package, code, ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", code.parent))
        _shipped.add(application)


class Workspace:
    """A fresh folder of Parquet tables, deleted when the session's JVM ends.

    A saved table cuts lineage: a lost executor costs its running tasks only, and what
    was decided in a table (a sample, a partition number) stays decided.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship_package(spark)
        self.spark = spark
        self.path = f"{shared_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
        root, self._fs = self._resolve(self.path)
        self._fs.deleteOnExit(root)

    def _resolve(self, path: str):
        jvm = self.spark.sparkContext._jvm
        resolved = jvm.org.apache.hadoop.fs.Path(path)
        return resolved, resolved.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and return it as read back."""
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that later ones were derived from."""
        for name in names:
            path, fs = self._resolve(f"{self.path}/{name}")
            fs.delete(path, True)
