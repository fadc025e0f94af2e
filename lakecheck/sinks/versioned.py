"""Crash-safe replacement of a whole dataset: a new version is written beside the old one, and the switch is the creation of
one empty file.

Under the dataset's path, ``v-<number>-<token>`` folders hold versions and ``_current`` holds one empty file per switch,
named like the version it makes current; the highest number rules.  Readers list that folder and read the version
it names, so they see the old rows until the switch and the new ones after it, never a mixture.  A job that dies
before the switch leaves a folder that nothing names; the next replacement clears it away with versions older than
the ``keep`` newest.  Creating an empty file is atomic in every Hadoop file system, object stores included; no rename
is needed.  One writer at a time is assumed, as for any dataset rewritten from itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTERS = "_current"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def current_version(spark: SparkSession, path: str) -> str | None:
    """The name of the version that readers see; None before the first."""
    return max(_names(spark, f"{path}/{POINTERS}"), default=None)


def stage(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> str:
    """Write ``df`` as the next version without making it current; its name."""
    now = current_version(df.sparkSession, path)
    name = f"v-{int(now.split('-')[1]) + 1 if now else 1:012d}-{uuid.uuid4().hex[:8]}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/{name}")
    return name


def switch(spark: SparkSession, path: str, name: str, keep: int = 2) -> None:
    """Make a staged version current, then clear versions that neither are nor were among the ``keep`` last."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    fs = _fs(spark, path)
    if not fs.exists(new(f"{path}/{name}/_SUCCESS")):
        raise ValueError(f"version {name} of {path} is not whole")
    fs.mkdirs(new(f"{path}/{POINTERS}"))
    fs.createNewFile(new(f"{path}/{POINTERS}/{name}"))
    last = _names(spark, f"{path}/{POINTERS}")
    kept = last[-keep:]
    for v in [n for n in _names(spark, path) if n.startswith("v-") and n not in kept]:
        fs.delete(new(f"{path}/{v}"), True)
    for v in last[:-keep]:
        fs.delete(new(f"{path}/{POINTERS}/{v}"), False)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, keep: int = 2) -> None:
    """Make ``df`` the dataset's content, also where ``df`` reads the dataset: no file it reads is touched before the switch."""
    switch(df.sparkSession, path, stage(df, path, partition_by), keep)


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version.  Readers that began earlier go on with theirs while it is among the ``keep`` last."""
    name = current_version(spark, path)
    if name is None:
        raise FileNotFoundError(f"{path} has no version")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/{name}")


def current_path(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version (to register as a table); None before the first."""
    name = current_version(spark, path)
    return None if name is None else f"{path}/{name}"
