"""Bucketed record diff: equal to the plain one, and only leaves with differences are compared."""

import random

import pytest
from pyspark.sql import functions as F

from lakecheck.operators import bucket_diff as B
from lakecheck.operators import recon

COLS = ["a", "b"]


def sides(seed, n=400):
    r = random.Random(seed)
    src = [(r.choice([i, i, i, None, r.randrange(40)]), r.choice([None, 0.0, 1.5]), r.choice([None, "", "x", "xy"])) for i in range(n)]
    tgt = [x for x in src if r.random() > 0.05]
    tgt = [(k, a, "changed" if r.random() < 0.03 else b) for k, a, b in tgt] + [(n + i, 1.0, "new") for i in range(5)]
    return src, tgt + tgt[:3]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,fanout", [(1, None), (2, 8), (3, 64), (4, 1)])
def test_equals_record_diff(spark, seed, fanout):
    schema = "k long, a double, b string, other int"
    src, tgt = (spark.createDataFrame([(*x, 7) for x in side], schema) for side in sides(seed))
    held = {}
    for side, n in ((src, 1), (tgt, -1)):
        for r in side.collect():
            held.setdefault(r["k"], {}).setdefault(tuple(r)[1:3], []).append(n)
    differ = {k for k, v in held.items() if any(sum(n) for n in v.values())}
    want = [r for r in rows(recon.record_diff(src, tgt, "k", COLS)) if r[0] in differ]
    assert want and rows(B.bucket_diff(src, tgt, "k", COLS, fanout)) == want
    assert rows(B.bucket_diff(src, src, "k", COLS, fanout)) == []


def test_empty_sides(spark):
    df = spark.createDataFrame([(1, 1.0, "x"), (2, None, None)], "k long, a double, b string")
    none = df.limit(0)
    assert rows(B.bucket_diff(none, none, "k", COLS)) == []
    assert rows(B.bucket_diff(df, none, "k", COLS)) == rows(recon.record_diff(df, none, "k", COLS))


@pytest.mark.parametrize("a,b", [(("x", None), (None, "x")), (("1:x", "y"), ("1", ":xy")), (("", None), (None, "")), (("a", "b"), ("ab", ""))])
def test_texts_are_unambiguous(spark, a, b):
    df = spark.createDataFrame([a, b], "x string, y string")
    assert df.select(B.row_text(df, ["x", "y"])).distinct().count() == 2


def test_copies_and_swapped_values_are_seen(spark):
    """Sums over rows do not hide a copy more or less, nor values that change places between rows."""
    s = spark.createDataFrame([(1, "a"), (1, "a"), (2, "p"), (3, "q")], "k long, v string")
    assert rows(B.bucket_diff(s, s.dropDuplicates(), "k", ["v"], 1)) == rows(recon.record_diff(s, s.dropDuplicates(), "k", ["v"]))
    t = spark.createDataFrame([(1, "a"), (1, "a"), (2, "q"), (3, "p")], "k long, v string")
    assert len(rows(B.bucket_diff(s, t, "k", ["v"], 1))) == 2


def test_rows_that_are_moved(spark, tmp_dir):
    """One row in a thousand differs: of 40,000 rows, only those of leaves with a difference pass the semi-join."""
    n = 40_000
    src = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    tgt = src.withColumn("v", F.when(F.col("k") % 1000 == 7, F.lit(-1)).otherwise(F.col("v")))
    src.write.parquet(f"{tmp_dir}/s")
    tgt.write.parquet(f"{tmp_dir}/t")
    src, tgt = spark.read.parquet(f"{tmp_dir}/s"), spark.read.parquet(f"{tmp_dir}/t")
    fanout = B.fanout_for(n)
    leaves = B.unequal_leaves(src, tgt, "k", ["v"], fanout)
    moved = B.rows_of_leaves(src, leaves, "k", fanout)
    assert leaves.count() <= 40 and moved.count() < 0.1 * n
    assert B.bucket_diff(src, tgt, "k", ["v"]).count() == 40
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_fanout_is_bounded():
    assert B.fanout_for(0) == 8 and B.fanout_for(10 ** 15) ** 2 == B.MAX_LEAVES
    for n in (1, 1000, 10 ** 6, 10 ** 9):
        f = B.fanout_for(n)
        assert f & (f - 1) == 0 and f * f <= B.MAX_LEAVES and (n / f ** 2 <= B.ROWS_PER_LEAF or f * f == B.MAX_LEAVES)
