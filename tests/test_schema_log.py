"""Schema log: columns and types of a growing dataset without reading its footers."""

import os

import pytest
from pyspark.sql import types as T

from lakecheck.sinks import runs, schema_log, writers


def test_added_columns_and_wider_types_are_read_back(spark, tmp_dir):
    runs.write_run(spark.createDataFrame([(1, 1.5, "a")], "k int, x float, s string"), tmp_dir, "r1")
    runs.write_run(spark.createDataFrame([(2 ** 40, 2.25, None, True)], "k long, x double, s string, new boolean"), tmp_dir, "r2")
    runs.write_run(spark.createDataFrame([(3,)], "k int"), tmp_dir, "r3")              # a narrower write changes nothing
    got = writers.read_runs(spark, tmp_dir)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [
        ("k", "bigint"), ("x", "double"), ("s", "string"), ("new", "boolean"), ("run_id", "string")]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[-1]) == [
        (1, 1.5, "a", None, "r1"), (2 ** 40, 2.25, None, True, "r2"), (3, None, None, None, "r3")]
    assert len([f for f in os.listdir(f"{tmp_dir}/_schema".removeprefix("file:")) if f.startswith("s-")]) == 2


def test_reads_open_no_footer(spark, tmp_dir):
    """The plan is made although a file's footer cannot be read."""
    runs.write_run(spark.createDataFrame([(1,)], "k int"), tmp_dir, "r1")
    folder = f"{tmp_dir}/run_id=r1".removeprefix("file:")
    part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    with open(f"{folder}/{part}", "wb") as f:
        f.write(b"no parquet")
    assert writers.read_runs(spark, tmp_dir).columns == ["k", "run_id"]


def test_types_that_do_not_widen_are_refused_before_the_write(spark, tmp_dir):
    runs.write_run(spark.createDataFrame([(1,)], "k int"), tmp_dir, "r1")
    with pytest.raises(schema_log.Incompatible, match="column k"):
        runs.write_run(spark.createDataFrame([("x",)], "k string"), tmp_dir, "r2")
    assert [r["run_id"] for r in writers.read_runs(spark, tmp_dir).collect()] == ["r1"]


@pytest.mark.parametrize("a,b,want", [
    (T.ByteType(), T.ShortType(), "smallint"), (T.LongType(), T.IntegerType(), "bigint"), (T.FloatType(), T.DoubleType(), "double"),
    (T.IntegerType(), T.DoubleType(), "double"), (T.DateType(), T.TimestampNTZType(), "timestamp_ntz"), (T.NullType(), T.StringType(), "string"),
    (T.DecimalType(10, 2), T.DecimalType(8, 4), "decimal(12,4)"), (T.DecimalType(5, 2), T.IntegerType(), "decimal(12,2)"),
    (T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), "array<bigint>"),
    (T.StructType([T.StructField("a", T.IntegerType())]), T.StructType([T.StructField("b", T.StringType())]), "struct<a:int,b:string>")])
def test_widened(a, b, want):
    assert schema_log.widened(a, b).simpleString() == want == schema_log.widened(b, a).simpleString().replace("b:string,a:int", "a:int,b:string")


@pytest.mark.parametrize("a,b", [(T.LongType(), T.DoubleType()), (T.StringType(), T.IntegerType()), (T.DecimalType(38, 0), T.DecimalType(38, 4))])
def test_not_widened(a, b):
    with pytest.raises(schema_log.Incompatible):
        schema_log.widened(a, b)


def test_dataset_without_a_log_is_read_by_its_footers(spark, tmp_dir):
    assert schema_log.logged(spark, tmp_dir) is None
    writers.write_runs(spark.createDataFrame([(1, "r1")], "k int, run_id string"), tmp_dir)
    assert writers.read_runs(spark, tmp_dir).collect()[0]["run_id"] == "r1"
