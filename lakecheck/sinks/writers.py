"""Parquet sinks.  No transactional table format is assumed (none is installed), so:

* run-scoped results are written partitioned by run id with *dynamic* partition overwrite:
  re-running a run replaces that run's partition only, other runs are untouched, and a
  filter on the run id prunes partitions on read;
* schema evolution of an append-only history is a read by the dataset's schema log (``sinks.schema_log``), or a
  Parquet ``mergeSchema`` read where it has none;
* rewriting a table from itself (maintenance dedup) first writes the new content beside it, which cuts the
  lineage to the files about to be replaced and is what an interrupted replacement is finished from;
* row counts of a write come from an ``Observation`` collected during that write, not from
  a second ``count()`` job over the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecheck.sinks import schema_log


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_runs(df: DataFrame, path: str, run_col: str = "run_id") -> None:
    """Write rows partitioned by run id; only the runs present in ``df`` are replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(run_col).parquet(path))


def read_runs(spark: SparkSession, path: str, schema: T.StructType | None = None,
              run_col: str = "run_id") -> DataFrame:
    """Read a run-partitioned dataset; older runs show NULL in columns added later.  The schema is the one given,
    else the dataset's schema log, else (a dataset without one) merged from the files' footers.  The run id always
    comes back as a string."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    known = schema_log.logged(spark, path)
    if known is not None:
        return spark.read.schema(T.StructType([*known.fields, T.StructField(run_col, T.StringType())])).parquet(path)
    merged = spark.read.option("mergeSchema", "true").parquet(path).schema
    # partition values are typed by inference (``0007`` would come back as 7); a given schema keeps the text
    as_text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == run_col else f for f in merged.fields])
    return spark.read.schema(as_text).parquet(path)


def redo_path(path: str) -> str:
    """Where a replacement of ``path`` keeps its new content until it is done."""
    return f"{path.rstrip('/')}__redo"


def delete_path(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def staged_replace(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Overwrite ``path`` with ``df`` even when ``df`` reads ``path``: the new content is first written whole beside it.
    A job that dies while it overwrites loses nothing: ``recover_replace`` does the rest from that copy.  Readers must not
    read in between; where they may, use ``sinks.versioned``."""
    spark = df.sparkSession
    recover_replace(spark, path, partition_by, wanted=False)
    df.write.mode("overwrite").parquet(f"{redo_path(path)}/rows")
    recover_replace(spark, path, partition_by)


def recover_replace(spark: SparkSession, path: str, partition_by: Sequence[str] | None = None, wanted: bool = True) -> bool:
    """Finish a replacement from its copy, if that is whole; whether it was.  A copy that is not whole was never read
    from: it is removed, and so is any copy if it is not ``wanted`` because all of the content comes anew."""
    redo = redo_path(path)
    if not path_exists(spark, redo):
        return False
    whole = wanted and path_exists(spark, f"{redo}/rows/_SUCCESS")
    if whole:
        overwrite(spark.read.parquet(f"{redo}/rows"), path, partition_by)
    delete_path(spark, redo)
    return whole


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write and read back: later stages start from files, not from the whole lineage."""
    overwrite(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row-count observation; read ``obs.get['rows']`` after the write action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def export_csv(df: DataFrame, path: str) -> None:
    """Report export: CSV with a header line (one file per task, as any Spark write)."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a dataset path exists, asked of its Hadoop file system (works for any
    shared store the cluster mounts).  A session without a JVM handle (Spark Connect) asks
    the Parquet reader instead: resolving the schema fails on a missing path."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # no py4j gateway in this session
        try:
            spark.read.parquet(path).schema
            return True
        except AnalysisException:
            return False
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(conf).exists(jpath)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def save_table(df: DataFrame, name: str, mode: str = "overwrite",
               partition_by: Sequence[str] | None = None) -> None:
    """Catalog table sink (Parquet); an overwrite replaces the schema as well."""
    w = df.write.format("parquet").mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> None:
    """Expose a path dataset as an external Parquet table ``name`` for SQL users.

    The table is re-created on every call (dropping an external table leaves its files), so
    its schema follows the files; partitioned datasets merge file schemas and have their
    run partitions recovered after each write."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    opts = {"mergeSchema": "true"} if partitioned else {}
    spark.catalog.createTable(name, path=path, source="parquet", **opts)
    if partitioned:
        spark.catalog.recoverPartitions(name)
