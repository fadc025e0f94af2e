"""Numbering, SCD2 and the date dimension."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakecheck.operators import dims
from lakecheck.operators.numbering import number_rows
from lakecheck.plans import queries as Q

from conftest import SF_SMALL


def test_number_rows_equals_global_row_number(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 100003).alias("k"))
    got = number_rows(df, ["k"], "sk", offset=100, buckets=13)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("k")) + 100)
    assert got.join(ref, "k").filter("sk <> rn").count() == 0
    assert got.count() == 5000
    assert got.agg(F.min("sk"), F.max("sk")).first() == (101, 5100)


def test_number_rows_string_keys_and_skewed_values(spark):
    keys = [f"k{i:05d}" for i in range(300)] + ["zz"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = sorted((r.k, r.sk) for r in number_rows(df, ["k"], "sk", buckets=4).collect())
    assert got == [(k, i + 1) for i, k in enumerate(sorted(keys))]


def test_number_rows_spreads_a_hot_order_value(spark):
    # a third of the rows share one order value; ties are broken by the row hash
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))).alias("k"),
                                  F.col("id").alias("v"))
    got = number_rows(df, ["k"], "sk", buckets=8)
    assert sorted(r.sk for r in got.collect()) == list(range(1, 3001))
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "v")))
    # positions of the non-tied keys agree with the window; tied rows fill their block
    cmp = got.join(ref, ["k", "v"])
    assert cmp.filter("k <> 7 and sk <> rn").count() == 0
    sizes = got.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(sizes) > 1
    again = {(r.k, r.v): r.sk for r in number_rows(df.repartition(5), ["k"], "sk", buckets=8).collect()}
    assert again == {(r.k, r.v): r.sk for r in got.collect()}  # repeatable


def test_number_rows_has_no_single_partition_exchange_over_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    plan = number_rows(df, ["k"], "sk")._jdf.queryExecution().executedPlan().toString()
    # the only SinglePartition exchange sits over the per-partition count table
    for line in plan.splitlines():
        if "SinglePartition" in line:
            idx = plan.splitlines().index(line)
            below = "\n".join(plan.splitlines()[idx:idx + 4])
            assert "HashAggregate" in below


def _dim(spark):
    src = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", None)],
                                "id int, name string, seg string")
    return dims.scd2_init(src, "id", "2025-01-01")


def test_scd2_init_dense_keys(spark):
    d = _dim(spark).orderBy("id").collect()
    assert [r.sk for r in d] == [1, 2, 3]
    assert all(r.is_current and r.end_date is None and r.effective_date == dt.date(2025, 1, 1) for r in d)


def test_scd2_reference_and_null_safe_semantics(spark):
    d = _dim(spark)
    inc = spark.createDataFrame([(1, "a", None), (2, "B", "y"), (3, "c", "now"), (4, "d", "w")],
                                "id int, name string, seg string")
    ref = sorted(r.id for r in dims.scd2_changes(inc, dims.current(d), "id", ["name", "seg"]).collect())
    ns = sorted(r.id for r in dims.scd2_changes(inc, dims.current(d), "id", ["name", "seg"], True).collect())
    assert ref == [2, 4]          # to/from NULL is missed
    assert ns == [1, 2, 3, 4]


def test_scd2_apply_closes_and_opens_versions(spark):
    d = _dim(spark)
    inc = spark.createDataFrame([(2, "B", "y"), (4, "d", "w")], "id int, name string, seg string")
    out = dims.scd2_apply(d, inc, "id", ["name", "seg"], "2025-06-01")
    rows = sorted((r.id, r.sk, r.is_current, r.end_date) for r in out.collect())
    assert rows == [(1, 1, True, None), (2, 2, False, dt.date(2025, 6, 1)), (2, 4, True, None),
                    (3, 3, True, None), (4, 5, True, None)]  # key 1 and 3 absent: stay current
    counts = dims.version_counts(out).first()
    assert (counts.current_rows, counts.total_rows) == (4, 5)


def test_scd2_apply_is_idempotent_on_unchanged_input(spark):
    d = _dim(spark)
    inc = d.select("id", "name", "seg")
    out = dims.scd2_apply(d, inc, "id", ["name", "seg"], "2025-06-01", null_safe=True)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, d.collect()))


def test_scd2_one_current_row_per_key_and_unique_sk(spark):
    out = Q.scd2_apply(spark, SF_SMALL)
    assert out.groupBy("patient_id").agg(F.count_if("is_current").alias("c")).filter("c <> 1").count() == 0
    assert out.select("patient_sk").distinct().count() == out.count() == 154
    assert out.filter("is_current").count() == 151


def test_date_dim(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2025, 1, 1),), (dt.date(2024, 12, 31),)],
                               "d date")
    rows = sorted(tuple(r) for r in dims.date_dim(df, "d").collect())
    assert rows == [(20241231, dt.date(2024, 12, 31), 2024, 12, 4, "Tuesday"),
                    (20250101, dt.date(2025, 1, 1), 2025, 1, 1, "Wednesday")]


def test_current_filter_reaches_parquet_scan(spark, tmp_dir):
    _dim(spark).write.parquet(tmp_dir)
    plan = dims.current(spark.read.parquet(tmp_dir))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_current,true)" in plan


def test_fact_lookup_splits_a_hot_patient(spark):
    # one patient holds half of all encounters; with broadcasting off, the lookup is a
    # sort-merge left join whose hot partition AQE splits (the dimension side is replicated)
    from lakecheck.operators import facts
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        enc = spark.range(6000).selectExpr(
            "id as encounter_id", "case when id % 2 = 0 then 7 else id % 500 end as patient_id",
            "date_add(date'2025-01-01', cast(id % 30 as int)) as encounter_date")
        dim = dims.scd2_init(spark.range(500).selectExpr("id as patient_id"), "patient_id", buckets=4)
        fact = facts.build_fact(enc, dim, "patient_id", "encounter_date",
                                ["encounter_id", "patient_id", "sk", "date_id"])
        assert fact.count() == 6000 and fact.filter("sk is null").count() == 0
        fact.collect()
        plan = fact._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
