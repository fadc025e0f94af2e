"""Incremental ingest: a ledger of files already loaded, so that a load reads new files only and a repeated load adds nothing.

The files under a folder are listed by Spark's file source (path, size and modification time; no content is read).  Files
that the ledger does not hold with that size and time are the load; its batch id is a hash of their list, so the same files
make the same batch.  Their rows replace that batch's partition, the ledger's batch is written last: a load that died
in between is not seen by ``read`` and is replaced when it is repeated.  A file that was rewritten is loaded again, and
``read`` leaves out the rows of its earlier state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecheck.sinks import runs
from lakecheck.sinks.writers import path_exists, read_runs
from lakecheck.sources.csv import read_csv

LEDGER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("modified", T.TimestampType()), T.StructField("load", T.IntegerType()),
    T.StructField("batch_id", T.StringType())])
PATH, BATCH = "_source_path", "batch_id"


def files(spark: SparkSession, base: str, glob: str = "*") -> DataFrame:
    """(path, size, modified) of the files under ``base`` whose names match ``glob``."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(base))
    return listed.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """The loaded files; empty before the first load."""
    path = f"{out.rstrip('/')}/ledger"
    return read_runs(spark, path, LEDGER_SCHEMA) if path_exists(spark, path) else spark.createDataFrame([], LEDGER_SCHEMA)


def new_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    return listed.join(known.select("path", "size", "modified"), ["path", "size", "modified"], "left_anti")


def ingest_new(spark: SparkSession, base: str, out: str, schema: T.StructType | str, glob: str = "*.csv",
               header: bool = True) -> dict[str, int]:
    """Load the files that are new since the last load: how many files, and the number of the load (0: nothing new)."""
    out = out.rstrip("/")
    known = ledger(spark, out)
    fresh = new_files(files(spark, base, glob), known)
    # a list of the load's files is what any reader of them needs on the driver
    load = [(r["path"], r["size"], r["modified"]) for r in fresh.orderBy("path").collect()]
    if not load:
        return {"files": 0, "load": 0}
    number = (known.agg(F.max("load")).first()[0] or 0) + 1
    listed = spark.createDataFrame(load, "path string, size bigint, modified timestamp")
    batch = listed.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("|", "path", F.col("size").cast("string"),
                                                                                  F.unix_micros("modified").cast("string")))), "\n"), 256)).first()[0]
    rows = read_csv(spark, [p for p, _, _ in load], schema, header=header).withColumn(PATH, F.col("_metadata.file_path"))
    runs.write_run(rows, f"{out}/data", batch, BATCH)
    runs.write_run(listed.withColumn("load", F.lit(number)), f"{out}/ledger", batch, BATCH)
    return {"files": len(load), "load": number}


def read(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all loads with their file's path and the number of the load; of a file loaded twice, the later state."""
    out = out.rstrip("/")
    latest = Window.partitionBy("path").orderBy(F.desc("load"))
    state = ledger(spark, out).withColumn("__lc_r", F.row_number().over(latest)).where("__lc_r = 1").select(
        F.col("path").alias(PATH), F.col("load").alias("_load"), BATCH)
    return read_runs(spark, f"{out}/data", run_col=BATCH).join(state, [PATH, BATCH]).drop(BATCH)
