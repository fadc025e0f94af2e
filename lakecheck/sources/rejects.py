"""CSV read that loses nothing: rows that are not whole and values that do not fit their type are kept as rejects.

The file is read as text, with Spark's corrupt-record column: a row with too few or too many fields is *malformed* and
goes to the rejects with its whole line (only there, unless asked otherwise).  Of the other rows each value is cast with ``try_cast``; one that has a text
but no value is NULL in the typed row, as in a permissive read, and a reject that names its column and holds the text.
The header, where there is one, must have the schema's names in its order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE, FILE = "__lc_line", "__lc_file"
MALFORMED, CAST = "malformed", "cast"
REJECT_COLUMNS = ["source_file", "reason", "column_name", "raw_value"]


def read_text(spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True) -> DataFrame:
    """Every field as text, with the line of rows that are not whole and the file's name."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(LINE, T.StringType())])
    reader = (spark.read.schema(as_text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
              .option("columnPruning", "false")        # else a row's fields are not counted where some are not asked for
              .option("header", str(header).lower()))
    if header:
        reader = reader.option("enforceSchema", "false")
    return reader.csv(path).withColumn(FILE, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def _typed(f: T.StructField) -> Column:
    raw = F.col(f.name)
    return (raw if isinstance(f.dataType, T.StringType) else F.trim(raw).try_cast(f.dataType)).alias(f.name)


def typed(text: DataFrame, schema: T.StructType, malformed: bool = False) -> DataFrame:
    """The whole rows in the schema's types; a value that does not fit is NULL.  With ``malformed``, rows that are not
    whole stay too, with the fields they have, as in a plain permissive read."""
    rows = text if malformed else text.where(F.col(LINE).isNull())
    return rows.select(*[_typed(f) for f in schema.fields])


def rejects(text: DataFrame, schema: T.StructType) -> DataFrame:
    """(source_file, reason, column_name, raw_value): a row per malformed line and per value that does not fit."""
    whole = F.col(LINE).isNull()
    found = [F.when(~whole, F.struct(F.lit(MALFORMED).alias("reason"), F.lit(None).cast("string").alias("column_name"), F.col(LINE).alias("raw_value")))]
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            bad = whole & F.col(f.name).isNotNull() & _typed(f).isNull()
            found.append(F.when(bad, F.struct(F.lit(CAST).alias("reason"), F.lit(f.name).alias("column_name"), F.col(f.name).alias("raw_value"))))
    each = text.select(F.col(FILE).alias("source_file"), F.explode(F.array(*found)).alias("r")).where(F.col("r").isNotNull())
    return each.select("source_file", "r.reason", "r.column_name", "r.raw_value")


def profile(reject_rows: DataFrame) -> DataFrame:
    """(reason, column_name, n_rows) over all files."""
    return reject_rows.groupBy("reason", "column_name").agg(F.count(F.lit(1)).alias("n_rows"))
