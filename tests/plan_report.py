"""Write PLANS.md: the final (adaptive) physical plan shape of the headline queries.

Run: python tests/plan_report.py /root/testdata/sf0.1
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lakecheck.plans import queries as Q  # noqa: E402
from lakecheck.session import get_spark  # noqa: E402

NAMES = ["clean_encounters", "dedup_lineitem", "issue_profile", "scd2_apply", "fact_build", "number_rows",
         "recon_checks", "recon_record_diff", "recon_diff_details", "results_summary", "report_diffs"]


NOTES = {
    "clean_encounters": "Three keep-first dedups (encounters by id, patients by id then by attributes): each has a "
                        "partial WindowGroupLimit before its exchange and a final one after. The referential filter "
                        "is a semi join, broadcast because AQE measured the id side as small.",
    "dedup_lineitem": "One hash exchange on (l_orderkey, l_linenumber) with a map-side WindowGroupLimit.",
    "issue_profile": "One aggregate pass. The only SinglePartition exchange is the one-row final of the global "
                     "aggregate. The orphan lookup is a left join with distinct parent ids.",
    "scd2_apply": "Surrogate keys come from number_rows: the range exchange runs inside the checkpoint, so here "
                  "only the per-partition count table (SinglePartition, at most `buckets` rows) and its broadcast "
                  "are visible. max(sk) is a scalar subquery. Changed keys are a (broadcast) join, not an IN list.",
    "fact_build": "The fact-to-dimension lookup is a left join; a large dimension would stay sort-merge, with AQE "
                  "splitting skewed fact partitions.",
    "number_rows": "Range partitioning plus sort are materialized by the checkpoint. The remaining plan is the "
                   "count table (hash plus SinglePartition over at most `buckets` rows) and a broadcast of the "
                   "offsets.",
    "recon_checks": "Both sides are unioned and grouped once into versions (one hash exchange on all compared "
                    "columns, partial aggregation first). The versions feed the global aggregate directly and, "
                    "through a key-level aggregate, the RECORD_DIFF pair count; no join of the two sides at all. "
                    "The only SinglePartition exchange is the aggregate's one-row final.",
    "recon_record_diff": "Versions (one exchange, reused), key statistics (partial + final aggregate; SortAggregate "
                         "because the single version of a side travels as a struct), then one sort-merge join of "
                         "versions with their key's statistics on (key, salt bucket). The hot-key list is broadcast "
                         "(at most 10,000 keys by construction), and both join inputs are plain shuffle stages, so "
                         "AQE may split skew.",
    "recon_diff_details": "The complete compact diff of the run, one row per differing version, tagged with the run id.",
    "results_summary": "Reads the stored, run-partitioned check log. max(run_id) is answered from partition "
                       "values (empty read schema), and the run filter prunes partitions.",
    "report_diffs": "Stored details: partition pruning on run_id, then a sort in key order.",
}


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def summarize(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    c = Counter()
    for m in re.finditer(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", final):
        c[f"Exchange {m.group(1)}"] += 1
    for m in re.finditer(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)"
                         r"(?: \[[^\]]*\], \[[^\]]*\],)? (\w+)", final):
        c[f"{m.group(1)} {m.group(2)}"] += 1
    for k in ("WindowGroupLimit", "ReusedExchange", "BroadcastExchange", "TakeOrderedAndProject",
              "CartesianProduct", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        n = final.count(k)
        if n:
            c[k] += n
    scans = []
    for m in re.finditer(r"FileScan (\w+) \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\], ReadSchema: (\S+)", final):
        loc = re.search(r"/([\w.-]+?)(?:\.parquet)?\]", final[m.start():m.start() + 600])
        scans.append((m.group(1), loc.group(1) if loc else "?", m.group(3)[:90], m.group(4)[:110]))
    return {"ops": c, "scans": sorted(set(scans))}


def main(sf: str) -> None:
    spark = get_spark()
    out = ["# PLANS", "",
           f"Final adaptive physical plans of the headline queries at `{os.path.basename(sf)}` on local mode "
           "(`spark.sql.shuffle.partitions` = 8, AQE on), generated by `tests/plan_report.py`. Counts are of the "
           "final plan; scans list format, table, pushed filters and read schema (deduplicated).", ""]
    for name in NAMES:
        s = summarize(final_plan(Q.QUERIES[name](spark, sf)))
        out.append(f"## {name}")
        out.append("")
        out.append(NOTES.get(name, ""))
        out.append("")
        out.append("| operator | count |")
        out.append("| --- | --- |")
        for k, v in sorted(s["ops"].items()):
            out.append(f"| {k} | {v} |")
        out.append("")
        out.append("| scan | table | pushed filters | read schema |")
        out.append("| --- | --- | --- | --- |")
        for fmt, table, pf, rs in s["scans"]:
            out.append(f"| {fmt} | {table} | `{pf or '-'}` | `{rs}` |")
        out.append("")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
