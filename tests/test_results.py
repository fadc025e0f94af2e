"""Check log -> summary, idempotent append, maintenance dedup, report views."""

from pyspark.sql import functions as F

from lakecheck.operators import results
from lakecheck.plans import queries as Q

from conftest import SF_SMALL


def _log(spark):
    rows = [("20250101_000000", "PASS", 0, "t1"), ("20250101_000000", "PASS", 0, "t1"),
            ("20250601_000000", "FAIL", 7, "t1"), ("20250601_000000", "PASS", 0, "t1"),
            ("20250601_000000", "FAIL", 2, "t2")]
    df = spark.createDataFrame(rows, "run_id string, status string, mismatch_count bigint, table_name string")
    return df.withColumn("run_ts", F.to_timestamp_ntz(F.substring("run_id", 1, 8), F.lit("yyyyMMdd")))


def test_latest_and_summary(spark):
    s = results.summarize(results.latest(_log(spark)))
    got = sorted((r.table_name, r.total_checks, r.passed, r.failed, r.total_mismatches, r.overall_status)
                 for r in s.collect())
    assert got == [("t1", 2, 1, 1, 7, "FAIL"), ("t2", 1, 0, 1, 2, "FAIL")]


def test_append_new_is_idempotent(spark):
    s = results.summarize(_log(spark))
    first = results.append_new(spark.createDataFrame([], s.schema), s)
    again = results.append_new(first, s)
    assert first.count() == again.count() == 3


def test_dedup_summary_keeps_one_row_per_run_and_table(spark):
    s = results.summarize(_log(spark))
    d = results.dedup_summary(s.unionByName(s))
    assert d.count() == 3  # a dedup by run_id alone would lose the t2 row


def test_report_views(spark):
    assert [r.run_id for r in Q.report_runs(spark, SF_SMALL).collect()] == ["20250601_000000", "20250101_000000"]
    rs = Q.report_run_summary(spark, SF_SMALL).collect()
    assert len(rs) == 1 and rs[0].overall_status == "FAIL" and rs[0].total_checks == 5
    assert [r.check_type for r in Q.report_checks(spark, SF_SMALL).collect()] == sorted(
        ["ROW_COUNT", "COLUMN_SUM", "COLUMN_SUM", "COLUMN_HASH", "RECORD_DIFF"])
    assert Q.report_diffs(spark, SF_SMALL).count() == 9
    assert [r.overall_status for r in Q.report_trend(spark, SF_SMALL).collect()] == ["FAIL", "PASS"]


def test_export_roundtrip(spark):
    back = sorted(tuple(r) for r in Q.export_roundtrip(spark, SF_SMALL).collect())
    view = sorted(tuple(r) for r in Q.report_checks(spark, SF_SMALL).collect())
    assert back == view
