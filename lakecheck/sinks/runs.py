"""Run-scoped datasets whose every run can be replaced, also by no rows, and the manifest of what a run wrote.

``write_run`` writes one run's rows to that run's partition folder and replaces it whole: unlike a dynamic partition
overwrite, which replaces only partitions that the new rows name, a re-run without rows leaves an empty partition, not
the old rows.  Spark writes a file with the schema also for no rows, so a dataset whose only run is empty can be read
and registered.

The manifest has a row per run and dataset, with the number of rows written; it is written last, so a run that it does
not list did not finish.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecheck.sinks import schema_log

MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_ts", T.TimestampNTZType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("n_rows", T.LongType()),
])
# fixed values: the characters that Hive-style partition folders write as %XX
_ESCAPED = {chr(c) for c in [*range(1, 32), 127]} | set("\"#%'*/:=?\\{}[]^")


def partition_folder(run_col: str, run_id: str) -> str:
    """The folder of a run, named as Spark names partition folders."""
    return f"{run_col}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(run_id))


def write_run(df: DataFrame, path: str, run_id: str, run_col: str = "run_id") -> None:
    """Replace run ``run_id`` of the dataset by ``df`` (a run column in it is not needed and ignored).  Its columns and types are
    recorded in the dataset's schema log, which ``writers.read_runs`` reads."""
    rows = df.drop(run_col)
    schema_log.record(df.sparkSession, path, rows.schema)
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{partition_folder(run_col, run_id)}")


def manifest_rows(spark: SparkSession, run_id: str, run_ts: str, counts: Mapping[str, int | None]) -> DataFrame:
    """A row per dataset that a run wrote."""
    rows = [(run_id, d, n) for d, n in sorted(counts.items())]
    out = spark.createDataFrame(rows, "run_id string, dataset string, n_rows bigint")
    return out.select("run_id", F.lit(str(run_ts)).cast("timestamp_ntz").alias("run_ts"), "dataset", "n_rows")


def finished(dataset: DataFrame, manifest: DataFrame, run_col: str = "run_id") -> DataFrame:
    """The rows of runs that the manifest lists."""
    listed = manifest.select(F.col("run_id").alias(run_col)).distinct()
    return dataset.join(listed, run_col, "left_semi").select(*dataset.columns)
