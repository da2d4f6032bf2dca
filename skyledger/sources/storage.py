"""The folder that driver and executors share, files in it by Spark's own file systems, and tables that cut lineage."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def _path(spark: SparkSession, at: str):
    """A Hadoop path and the file system it lies in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def resolved(spark: SparkSession, at: str) -> str:
    """A path with its scheme, so that Spark and the driver mean the same file system."""
    path, files = _path(spark, at)
    return re.sub("^file:/+", "file:///", files.makeQualified(path).toString()).rstrip("/")


def uri(at: str | os.PathLike) -> str:
    """A path of a mount that driver and executors share, with its scheme: Spark, whatever its default file system is, then
    means the same files as the driver and the simulators do."""
    return at if "://" in str(at) else f"file://{os.path.abspath(at)}"


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    return bool(re.match(r"local(\[|$)", spark.sparkContext.master))


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a session that is one process uses a temporary folder until it ends; on a
    cluster that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or _own.get("at")
    if not at:
        if not is_local(spark):
            raise ValueError(f"spark.checkpoint.dir must name a folder that the driver and all executors of {spark.sparkContext.master} share")
        folder = tempfile.mkdtemp(prefix="skyledger-")
        atexit.register(shutil.rmtree, folder, True)
        at = _own["at"] = f"file://{folder}"
    return resolved(spark, at)


def fresh(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read again."""
    at = fresh(df.sparkSession, what)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def remove(spark: SparkSession, at: str) -> None:
    path, files = _path(spark, at)
    files.delete(path, True)


def listed(spark: SparkSession, at: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    path, files = _path(spark, at)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []
