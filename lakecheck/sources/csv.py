"""Raw-file ingest: CSV with header -> DataFrame with lineage columns.

An explicit schema is the default (schema inference costs an extra pass over the file and
can change from file to file); ``infer=True`` gives the reference's behaviour.  Lineage:
``_ingestion_ts`` (the run timestamp, or the current timestamp) and ``_source_file`` (the
logical file name of the registry entry).  ``source_path_col`` adds the physical file path
from the hidden ``_metadata`` column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False, header: bool = True) -> DataFrame:
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        # with a header, a column order or name that differs from the schema is an error, never a silent swap
        reader = reader.schema(schema).option("enforceSchema", "false")
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def add_lineage(df: DataFrame, file_name: str, ingestion_ts=None,
                source_path_col: str | None = None) -> DataFrame:
    ts = (F.current_timestamp().cast("timestamp_ntz") if ingestion_ts is None
          else F.lit(str(ingestion_ts)).cast("timestamp_ntz"))
    out = df.withColumn("_ingestion_ts", ts).withColumn("_source_file", F.lit(file_name))
    if source_path_col:
        out = out.withColumn(source_path_col, F.col("_metadata.file_path"))
    return out


def ingest(spark: SparkSession, base_path: str, files: Mapping[str, str],
           schemas: Mapping[str, T.StructType | str] | None = None, infer: bool = False,
           ingestion_ts=None) -> dict[str, DataFrame]:
    """``{table: file name}`` under ``base_path`` -> ``{table: raw DataFrame with lineage}``."""
    out = {}
    for table, file_name in files.items():
        schema = (schemas or {}).get(table)
        df = read_csv(spark, f"{base_path.rstrip('/')}/{file_name}", schema, infer=infer)
        out[table] = add_lineage(df, file_name, ingestion_ts)
    return out
