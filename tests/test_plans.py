"""Plan shape: no Python UDFs, pruned scans, no cartesian products, map-side limits."""

import pytest

from lakecheck.plans import queries as Q

from conftest import SF_SMALL

SKIP = {"ingest_audit", "fact_history", "export_roundtrip", "pipeline_summary"}  # these write files first


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - SKIP))
def test_no_python_udf_and_no_cartesian(spark, name):
    plan = Q.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_scan_reads_only_needed_columns(spark):
    plan = Q.recon_row_hash(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderstatus" not in plan and "o_orderdate" not in plan


def test_dedup_has_partial_window_group_limit(spark):
    plan = Q.dedup_lineitem(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_versions_are_shuffled_once_and_reused(spark):
    # the union of both sides is grouped once; the metrics, the key statistics and the diff
    # join all read that one exchange (ReusedExchange), never a second grouping of the rows
    import re
    from lakecheck.operators import recon
    src = spark.range(2000).selectExpr("id % 700 as id", "id % 7 as a", "cast(id % 3 as string) as b")
    tgt = spark.range(1500).selectExpr("id % 700 as id", "id % 5 as a", "cast(id % 3 as string) as b")
    spec = recon.CheckSpec(key="id", sum_cols=("a",), hash_cols=("id", "a", "b"), compare_cols=("a", "b"),
                           table_name="s -> t")
    for df in (recon.run_checks(src, tgt, spec, "r", "2025-01-01 00:00:00"),
               recon.record_diff(src, tgt, "id", ["a", "b"])):
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        grouping = [line for line in final.splitlines() if "ReusedExchange" not in line
                    and re.search(r"Exchange hashpartitioning\(id#\d+L, a#\d+L, b#\d+,", line)]
        assert len(grouping) == 1, final
        assert "ReusedExchange" in final
