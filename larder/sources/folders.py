"""Folders of a run's own in storage that the driver and all executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, and on one machine only, a temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = f"file://{tempfile.mkdtemp(prefix='larder-')}"
        atexit.register(remove, spark, _own[app])
    return _own[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses, removed when the driver ends."""
    path = f"{shared(spark)}/larder-{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def _file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _file(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a run made, if it is there; at the driver's end the JVM may be gone."""
    try:
        target, fs = _file(spark, path)
        fs.delete(target, True)
    except Exception:
        pass


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a folder of their own and read back: what comes after starts from there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
