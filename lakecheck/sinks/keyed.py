"""A dataset stored in partitions by the hash of its key, where a change rewrites only the partitions it touches.

``write`` lays the rows out under ``bucket=<n>`` folders.  ``update`` takes a function from the rows of the touched
buckets to their next rows; it reads those buckets only, writes their next content to a staged folder and then replaces
the buckets by dynamic partition overwrite.  The staged folder is the redo copy: it is complete once its ``_SUCCESS`` file
is there, the replacement can be repeated from it any number of times, and it goes when the replacement is done.  ``open_``
and ``update`` finish a replacement that was interrupted, so a job that dies within it loses nothing and mixes nothing.

The touched buckets are at most ``buckets`` numbers; nothing else comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecheck.sinks.writers import delete_path, path_exists, redo_path

BUCKET = "__bucket"
COUNT = "_buckets-"       # an empty file of this name and the number of buckets marks a whole dataset


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _marks(spark: SparkSession, path: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.startswith(COUNT)] if fs.exists(p) else []


def is_keyed(spark: SparkSession, path: str) -> bool:
    """Whether a whole keyed dataset is at ``path``."""
    return bool(_marks(spark, path))


def buckets_of(spark: SparkSession, path: str) -> int:
    """The number of buckets the dataset was written with."""
    found = _marks(spark, path)
    if not found:
        raise FileNotFoundError(f"{path} was not written whole by keyed buckets")
    return int(found[0][len(COUNT):])


def _replace_from_redo(spark: SparkSession, path: str) -> None:
    redo = redo_path(path)
    staged = spark.read.parquet(f"{redo}/rows")
    staged.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    # dynamic overwrite leaves a touched bucket alone whose next content has no rows
    touched = spark.read.parquet(f"{redo}/touched")
    for (n,) in touched.join(F.broadcast(staged.select(BUCKET).distinct()), BUCKET, "left_anti").collect():   # at most one a bucket
        delete_path(spark, f"{path}/{BUCKET}={n}")
    delete_path(spark, redo)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish an interrupted replacement; whether there was one.  A staged folder whose rows were not written whole
    was never replaced from: it is removed."""
    redo = redo_path(path)
    if not path_exists(spark, redo):
        return False
    if path_exists(spark, f"{redo}/rows/_SUCCESS"):
        _replace_from_redo(spark, path)
        return True
    delete_path(spark, redo)
    return False


def write(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A first load: all rows, one folder a bucket."""
    recover(df.sparkSession, path)
    placed = df.withColumn(BUCKET, bucket_of(F.col(key), buckets))
    placed.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path}/{COUNT}{buckets}")
    p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).createNewFile(p)


def open_(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows with their bucket; an interrupted replacement is finished first."""
    recover(spark, path)
    return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)


def stage(spark: SparkSession, path: str, numbers: list[int], next_rows: DataFrame) -> None:
    """Write the next content of the touched buckets as the redo copy, the rows last."""
    spark.createDataFrame([(n,) for n in numbers], f"{BUCKET} int").write.mode("overwrite").parquet(f"{redo_path(path)}/touched")
    next_rows.write.mode("overwrite").parquet(f"{redo_path(path)}/rows")


def update(spark: SparkSession, path: str, touched: DataFrame, next_of: Callable[[DataFrame], DataFrame]) -> list[int]:
    """Replace the buckets listed in ``touched`` (a column of bucket numbers) by ``next_of`` of their rows; the buckets.
    ``next_of`` keeps the bucket column and each row's bucket."""
    recover(spark, path)
    numbers = sorted(r[0] for r in touched.distinct().collect())           # at most one a bucket
    if numbers:
        stage(spark, path, numbers, next_of(spark.read.parquet(path).where(F.col(BUCKET).isin(numbers))))
        _replace_from_redo(spark, path)
    return numbers
