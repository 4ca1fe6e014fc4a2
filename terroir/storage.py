"""The shared folder of the cluster, for tables that cut lineage, ."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_SCRATCH: list[str] = []


def _local(application: str) -> str:
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="terroir-")
    return _LOCAL[application]


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is named and Spark is local."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        # A driver's plain local session; the cluster's executors would not see this folder.
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        configured = _local(context.applicationId)
    return f"{configured.rstrip('/')}/terroir/{context.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the current scratch folder, or the application's shared folder, that nothing else uses."""
    return f"{_SCRATCH[-1] if _SCRATCH else shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in the file system of its path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside go to a folder of their own, which is deleted at the end: write results before that."""
    folder = new_path(spark, "scratch")
    _SCRATCH.append(folder)
    try:
        yield
    finally:
        _SCRATCH.remove(folder)
        remove(spark, folder)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: computed once, safe from lost executors, of known size."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
