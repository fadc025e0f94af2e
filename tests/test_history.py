"""Change-only history against the full copies it stands for."""

import random

import pytest
from pyspark.sql import functions as F

from lakecheck.operators import history as H

SCHEMA = "k long, v string"


def snapshots(seed, n_runs=6):
    r = random.Random(seed)
    rows = [(r.choice([i, None]), r.choice(["a", "b", None])) for i in range(30)]
    out = []
    for _ in range(n_runs):
        rows = [x if r.random() > 0.15 else (x[0], r.choice(["a", "b", "c"])) for x in rows if r.random() > 0.05]
        rows += [r.choice(rows) for _ in range(2)] if rows else []
        out.append(list(rows))
    out[2] = list(out[1])                                     # a run without changes
    return {f"run{i}": x for i, x in enumerate(out)}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def full(spark, snaps):
    return spark.createDataFrame([(*x, run) for run, s in snaps.items() for x in s], SCHEMA + ", run string")


@pytest.mark.parametrize("seed", [1, 2])
def test_stored_history_rebuilds_every_run(spark, tmp_dir, seed):
    snaps = snapshots(seed)
    for run, s in snaps.items():
        H.append_run(spark, tmp_dir, spark.createDataFrame(s, SCHEMA), run)
    got = H.read(spark, tmp_dir)
    assert H.run_ids(spark, tmp_dir) == list(snaps)
    assert rows(got.select("k", "v", H.COPIES, H.FROM, H.TO)) == rows(H.compact(full(spark, snaps), "run").select("k", "v", H.COPIES, H.FROM, H.TO))
    assert rows(H.copies(H.expand(got, list(snaps), "run"))) == rows(full(spark, snaps))
    for run, s in snaps.items():
        assert rows(H.copies(H.as_of(got, run))) == sorted(s, key=str)
    assert got.count() < sum(len(set(s)) for s in snaps.values())


def test_size_grows_with_changes(spark, tmp_dir):
    base = spark.range(500).select(F.col("id").alias("k"), F.lit("same").alias("v"))
    for i in range(4):
        H.append_run(spark, tmp_dir, base.withColumn("v", F.when(F.col("k") == i, F.lit("other")).otherwise(F.col("v"))), f"r{i}")
    assert H.read(spark, tmp_dir).count() == 500 + 2 * 3 + 1 - 1


def test_last_run_can_be_repeated_and_order_is_kept(spark, tmp_dir):
    a, b, c = (spark.createDataFrame(x, SCHEMA) for x in ([(1, "a")], [(1, "b"), (2, "x")], [(1, "a"), (3, "z")]))
    H.append_run(spark, tmp_dir, a, "r1")
    H.append_run(spark, tmp_dir, b, "r2")
    H.append_run(spark, tmp_dir, c, "r2")                     # again, with other rows
    assert rows(H.as_of(H.read(spark, tmp_dir), "r2")) == [(1, "a", 1), (3, "z", 1)]
    assert rows(H.as_of(H.read(spark, tmp_dir), "r1")) == [(1, "a", 1)]
    with pytest.raises(ValueError):
        H.append_run(spark, tmp_dir, a, "r0")
    H.append_run(spark, tmp_dir, a.limit(0), "r3")            # a run without rows closes everything
    assert rows(H.as_of(H.read(spark, tmp_dir), "r3")) == [] and rows(H.as_of(H.read(spark, tmp_dir), "r2")) == [(1, "a", 1), (3, "z", 1)]


def test_a_run_that_died_is_not_seen(spark, tmp_dir, monkeypatch):
    a, b = (spark.createDataFrame(x, SCHEMA) for x in ([(1, "a"), (2, "x")], [(1, "b")]))
    H.append_run(spark, tmp_dir, a, "r1")
    before = rows(H.read(spark, tmp_dir))

    def die(*_, **__):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(H.versioned, "replace", die)
        with pytest.raises(RuntimeError):
            H.append_run(spark, tmp_dir, b, "r2")
    assert rows(H.read(spark, tmp_dir)) == before
    H.append_run(spark, tmp_dir, b, "r2")
    assert rows(H.as_of(H.read(spark, tmp_dir), "r2")) == [(1, "b", 1)]


def test_no_runs(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        H.read(spark, tmp_dir)
    assert H.compact(full(spark, {}), "run").collect() == []
