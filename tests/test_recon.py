"""Reconciliation checks: row count, sums, fingerprint, record diff, details, check log."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakecheck.operators import recon
from lakecheck.plans import queries as Q
from lakecheck.sources import fixtures as fx

from conftest import SF_SMALL

SCHEMA = "id int, a string, b double"
SPEC = recon.CheckSpec(key="id", sum_cols=("b",), hash_cols=("id", "a", "b"), compare_cols=("a", "b"),
                       table_name="s -> t")


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _checks(spark, src, tgt, spec=SPEC):
    out = recon.run_checks(_df(spark, src), _df(spark, tgt), spec, "r1", "2025-01-01 00:00:00")
    return {(r.check_type, r.metric_name): r for r in out.collect()}


def test_clean_input_passes_everything(spark):
    c = Q.recon_checks_clean(spark, SF_SMALL).collect()
    assert len(c) == 5 and all(r.status == "PASS" and r.mismatch_count == 0 for r in c)


def test_dirty_input_fails_with_reference_counts(spark):
    c = {r.check_type + ":" + r.metric_name: r for r in Q.recon_checks(spark, SF_SMALL).collect()}
    assert (c["ROW_COUNT:row_count"].source_value, c["ROW_COUNT:row_count"].target_value) == ("1503", "1492")
    assert c["ROW_COUNT:row_count"].mismatch_count == 11
    assert c["COLUMN_SUM:sum_billing_amount"].source_value == "373615825.91"
    assert c["COLUMN_SUM:sum_billing_amount"].target_value == "372670783.85"
    assert c["COLUMN_SUM:sum_length_of_stay"].source_value == "11238.00"
    assert c["COLUMN_SUM:sum_length_of_stay"].target_value == "11143.00"
    assert c["RECORD_DIFF:mismatched_rows"].mismatch_count == 9
    assert all(r.status == "FAIL" for r in c.values())


def test_fingerprint_order_independent_and_multiplicity_sensitive(spark):
    rows = [(i, f"x{i}", i * 1.5) for i in range(200)]
    a = recon.fingerprint(_df(spark, rows), ["id", "a", "b"]).first()[0]
    b = recon.fingerprint(_df(spark, list(reversed(rows))).repartition(7), ["id", "a", "b"]).first()[0]
    c = recon.fingerprint(_df(spark, rows + rows[:1]), ["id", "a", "b"]).first()[0]
    assert a == b and a != c


def test_concat_ws_skips_nulls_unless_a_token_is_given(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    from lakecheck.functions.hashing import row_hash
    loose = [r[0] for r in df.select(row_hash(df, ["x", "y", "z"])).collect()]
    strict = [r[0] for r in df.select(row_hash(df, ["x", "y", "z"], null_token="\\N")).collect()]
    assert loose[0] == loose[1] and strict[0] != strict[1]


def test_empty_tables_pass_the_fingerprint(spark):
    c = _checks(spark, [], [])
    assert c[("COLUMN_HASH", "table_fingerprint_md5")].status == "PASS"
    assert c[("COLUMN_SUM", "sum_b")].source_value == "0.00"


def test_column_sum_tolerance(spark):
    c = _checks(spark, [(1, "a", 1.004)], [(1, "a", 1.0)])
    assert c[("COLUMN_SUM", "sum_b")].status == "PASS"  # per-value decimal(18,2): 1.00 vs 1.00
    c = _checks(spark, [(1, "a", 1.02)], [(1, "a", 1.0)])
    assert c[("COLUMN_SUM", "sum_b")].status == "FAIL" and c[("COLUMN_SUM", "sum_b")].mismatch_count == 1


def test_exact_source_duplicates_pass_record_diff_only(spark):
    c = _checks(spark, [(1, "a", 1.0), (1, "a", 1.0), (2, "b", 2.0)], [(1, "a", 1.0), (2, "b", 2.0)])
    assert c[("RECORD_DIFF", "mismatched_rows")].status == "PASS"
    assert c[("ROW_COUNT", "row_count")].status == "FAIL"
    assert c[("COLUMN_SUM", "sum_b")].status == "FAIL"
    assert c[("COLUMN_HASH", "table_fingerprint_md5")].status == "FAIL"


def test_record_diff_three_valued_rules(spark):
    src = _df(spark, [(1, "a", 1.0), (1, "z", 1.0), (2, None, None), (None, "n", 1.0), (3, "c", None)])
    tgt = _df(spark, [(1, "a", 1.0), (1, "a", 1.0), (None, "n", 1.0), (3, "c", None), (4, "d", 4.0)])
    nkey = lambda t: tuple((x is None, x if x is not None else 0) for x in t)
    rows = sorted((tuple(r) for r in recon.expand_diff(recon.record_diff(src, tgt, "id", ["a", "b"])).collect()),
                  key=lambda t: repr(nkey(t)))
    # key 1: ('z') pairs with both target copies; key 2: all-NULL one-sided row is not flagged;
    # NULL keys never match (both sides flagged); key 3 equal with NULLs; key 4 target only
    assert rows == sorted([
        (1, "z", 1.0, "a", 1.0), (1, "z", 1.0, "a", 1.0),
        (None, "n", 1.0, None, None), (None, None, None, "n", 1.0),
        (4, None, None, "d", 4.0)], key=lambda t: repr(nkey(t)))
    compact = recon.record_diff(src, tgt, "id", ["a", "b"]).filter("id = 1").first()
    assert compact.n_rows == 2  # one compact row stands for the two row-level pairs


def test_diff_details_first_n_in_key_order(spark):
    src = _df(spark, [(i, "s", float(i)) for i in range(50)])
    tgt = _df(spark, [(i, "t", float(i)) for i in range(50)])
    d = recon.diff_details(recon.record_diff(src, tgt, "id", ["a", "b"]), "id", "r9", n=7).collect()
    assert [r.id for r in d] == list(range(7)) and {r.run_id for r in d} == {"r9"}


def test_fixture_diff_counts(spark):
    d = Q.recon_record_diff(spark, SF_SMALL)
    assert d.agg(F.sum("n_rows")).first()[0] == 9


@pytest.mark.parametrize("name", ["recon_row_count", "recon_column_sum", "recon_fingerprint",
                                  "recon_record_diff_check"])
def test_single_checks_match_the_combined_log(spark, name):
    single = {(r.check_type, r.metric_name): tuple(r) for r in Q.QUERIES[name](spark, SF_SMALL).collect()}
    combined = {(r.check_type, r.metric_name): tuple(r) for r in Q.recon_checks(spark, SF_SMALL).collect()}
    for k, v in single.items():
        assert combined[k] == v


def test_record_diff_hot_key_is_counted_not_paired(spark):
    # key 0 holds half of each side, with 2000 source versions and 3 target versions: the
    # reference's join has 2000 x 2000 pairs for it.  The check counts them exactly from
    # key-level aggregates; the diff lists each version once (linear), and AQE splits the
    # hot key's partition where versions meet their key's statistics.
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
        n = 4000
        key = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("k")
        src = spark.range(n).select(key, F.col("id").alias("a"))
        tgt = spark.range(n).select(key, (F.col("id") % 3).alias("a"))
        d = recon.record_diff(src, tgt, "k", ["a"])
        src_hot = [i for i in range(0, n, 2)]                 # payloads of key 0 in the source
        tgt_hot = Counter(i % 3 for i in range(0, n, 2))     # and their counts in the target
        want_hot = sum(c for a in src_hot for x, c in tgt_hot.items() if a != x)
        want_rest = sum(1 for i in range(1, n, 2) if i != i % 3)
        hot = [r for r in d.collect() if r.k == 0]
        assert len(hot) == len(src_hot) + len(tgt_hot)
        assert sum(r.n_rows for r in hot if r.src_a is not None) == len(src_hot)
        spec = recon.CheckSpec(key="k", sum_cols=(), hash_cols=("k", "a"), compare_cols=("a",),
                               table_name="s -> t")
        chk = recon.record_diff_check(src, tgt, spec, "r", "2025-01-01 00:00:00").first()
        assert chk.mismatch_count == want_hot + want_rest
        plan = d._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_salted_hot_key_gives_the_same_diff(spark, monkeypatch):
    # shrink the bucket so key 0 (half of all versions) is salted into many buckets
    from test_properties import brute_compact
    monkeypatch.setattr(recon, "SPLIT_VERSIONS", 64)
    src_rows = [(0 if i % 2 == 0 else i, i, "x") for i in range(3000)]
    tgt_rows = [(0 if i % 2 == 0 else i, i % 7, None if i % 5 == 0 else "x") for i in range(1500)]
    schema = "id int, a int, b string"
    s, t = spark.createDataFrame(src_rows, schema), spark.createDataFrame(tgt_rows, schema)
    d = recon.record_diff(s, t, "id", ["a", "b"])
    got = Counter()
    for r in d.collect():
        got[tuple(r)[:-1]] += r.n_rows
    assert got == brute_compact(src_rows, tgt_rows)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan and "BroadcastHashJoin" in plan
    stats = recon.key_stats(recon.versions(s, t, ["id", "a", "b"]), "id", ["a", "b"])
    hot = stats.where("id = 0").first()
    assert hot["__lc_ds"] + hot["__lc_dt"] > 64   # key 0 really was split into buckets


def test_key_only_diff(spark):
    # no compared columns: only keys on one side count (a one-sided all-NULL row is not flagged,
    # as in the reference), so the diff is empty and the count is zero
    src = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    tgt = spark.createDataFrame([(2,), (3,)], "id int")
    assert recon.record_diff(src, tgt, "id", []).count() == 0
    spec = recon.CheckSpec(key="id", sum_cols=(), hash_cols=("id",), compare_cols=(), table_name="s -> t")
    assert recon.record_diff_check(src, tgt, spec, "r", "2025-01-01 00:00:00").first().mismatch_count == 0


def test_key_differences_reach_the_check_log_as_one_row(spark):
    s = _df(spark, [(1, "a", 1.0), (1, "z", 1.0), (2, "b", 2.0), (None, "n", 1.0), (3, "c", None)])
    t = _df(spark, [(1, "a", 1.0), (1, "a", 1.0), (None, "n", 1.0), (3, "c", None), (4, "d", 4.0)])
    v = recon.versions(s, t, ["id", "a", "b"])
    each = recon.key_stats(v, "id", ["a", "b"]).select("__lc_d").collect()
    assert len(each) == 5
    assert [int(r[0]) for r in recon.diff_count_rows(v, "id", ["a", "b"]).collect()] == [sum(int(r[0]) for r in each)] == [6]
    assert [r[0] for r in recon.diff_count_rows(v.where("false"), "id", ["a", "b"]).collect()] == [None]


def test_a_table_against_itself_is_grouped_apart_from_its_own_sorts(spark):
    from lakecheck.operators.quality import dedup
    c = dedup(_df(spark, [(i % 50 if i % 9 else None, f"x{i % 3}", float(i % 4)) for i in range(200)]), ["id"])
    v = recon.versions(c, c, ["id", "a", "b"])
    over = v._jdf.queryExecution().executedPlan().toString().split("Union")[0]
    assert over.count("Exchange hashpartitioning(id") == 1, over       # between the sides' windows and the grouping
    assert all(r["__lc_sn"] == r["__lc_tn"] == 1 for r in v.collect()) and v.count() == c.count() == 51
    assert recon.record_diff(c, c, "id", ["a", "b"]).where("id is not null").count() == 0


def test_versions_are_combined_apart_from_the_sides_own_sorts(spark):
    from lakecheck.operators.quality import dedup
    c = dedup(_df(spark, [(i, f"x{i % 3}", float(i % 4)) for i in range(200)]), ["id"])
    v = recon.versions(_df(spark, [(1, "x1", 1.0)]), c, ["id", "a", "b"])
    lines = v._jdf.queryExecution().executedPlan().toString().splitlines()
    above = lines[:next(i for i, line in enumerate(lines) if "Union" in line)]
    kinds = [next(k for k in ("HashAggregate", "Exchange") if k in line) for line in above if "HashAggregate" in line or "Exchange" in line]
    assert kinds[-1] == "Exchange" and kinds.count("Exchange") == 2, lines       # nothing is combined in the sides' tasks
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = v.rdd.getNumPartitions()
    assert parts == min(4 * n, 200) > n                                          # and the groups are in smaller ones


def test_versions_of_a_hot_row_and_of_equal_doubles(spark):
    zero, nan = [0.0, -0.0], float("nan")
    src = [(7, "h", 1.5)] * 3000 + [(1, "z", zero[i % 2]) for i in range(40)] + [(None, None, nan), (2, None, None)] * 5
    tgt = [(7, "h", 1.5)] * 20 + [(1, "z", -0.0), (None, None, nan), (2, None, 0.0)]
    v = recon.versions(_df(spark, src).repartition(6), _df(spark, tgt).repartition(3), ["id", "a", "b"])
    assert v.columns == ["id", "a", "b", recon.SN, recon.TN]
    got = Counter({(r.id, r.a, str(r.b)): (r[recon.SN], r[recon.TN]) for r in v.collect()})
    assert got == {(7, "h", "1.5"): (3000, 20), (1, "z", "0.0"): (40, 1), (None, None, "nan"): (5, 1),
                   (2, None, "None"): (5, 0), (2, None, "0.0"): (0, 1)}
    assert v.count() == 5


def test_versions_of_doubles_only(spark):
    s = _df(spark, [(i, "a", float(i % 3)) for i in range(30)]).select("b")
    assert sorted(map(tuple, recon.versions(s, s, ["b"]).collect())) == [(0.0, 10, 10), (1.0, 10, 10), (2.0, 10, 10)]
