"""Tables as versions behind a pointer file: written beside the old one, switched by one rename, expired later.

A table's folder holds one folder for each version and ``current.txt``, which names the versions newest first. Replacing
that small file is the only step that readers can see, so they find the old or the new version and never none. A
reader resolves the pointer once and keeps its version until it has been expired.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from terroir.storage import remove

POINTEUR = "current.txt"


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file by rename, so readers see the old or the new text."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    staged = jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
    out = target.getFileSystem(conf).create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    context.rename(staged, target, options)


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    try:
        return spark.read.text(path, wholetext=True).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def new_version() -> str:
    return f"v-{uuid.uuid4().hex}"


def versions(spark: SparkSession, root: str) -> list[str]:
    """The versions that the pointer names, newest first; folders of failed writes are not among them."""
    return (read_file(spark, f"{root}/{POINTEUR}") or "").split()


def switch(spark: SparkSession, root: str, version: str) -> None:
    """Make a completely written version the current one."""
    replace_file(spark, f"{root}/{POINTEUR}", "\n".join([version, *versions(spark, root)]))


def expire(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all but the ``keep`` newest versions. A crash in between leaves names whose folders go next time."""
    if keep < 1:
        raise ValueError("the current version stays")
    listed = versions(spark, root)
    for old in listed[keep:]:
        remove(spark, f"{root}/{old}")
    if listed[keep:]:
        replace_file(spark, f"{root}/{POINTEUR}", "\n".join(listed[:keep]))


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The current version; the frame stays with it when a newer one is switched to."""
    listed = versions(spark, root)
    if not listed:
        raise FileNotFoundError(f"no version of {root}")
    return spark.read.parquet(f"{root}/{listed[0]}")
