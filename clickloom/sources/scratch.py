"""Folders for tables that live as long as the session."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Names the folder; without it ``spark.checkpoint.dir``, then the warehouse folder.
SETTING = "spark.clickloom.scratch"


def _resolve(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all that is in it; one that is not there is no error."""
    path, files = _resolve(spark, folder)
    files.delete(path, True)


def scratch_folder(spark: SparkSession, name: str = "scratch") -> str:
    """A new path every executor can reach, deleted when the session's JVM ends."""
    root = (
        spark.conf.get(SETTING, None)
        or spark.conf.get("spark.checkpoint.dir", None)
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    folder = f"{root.rstrip('/')}/clickloom-{name}-{uuid.uuid4().hex}"
    path, files = _resolve(spark, folder)
    files.deleteOnExit(path)
    return folder
