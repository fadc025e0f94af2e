"""DuckDB SQL oracles for the registered queries (independent of the Spark code path).

Each query is ``WITH <fixture views> <query>``; only the base tables (region, supplier,
customer, orders, lineitem, ...) must exist.  Text forms follow the rules both engines
agree on: amounts become text only through decimal, hex prefixes are cast via '0x' ||.
"""

from __future__ import annotations

# fixed values shared with lakecheck.sources.fixtures (dates, run ids, table label)
RUN1_ID, RUN1_TS = "20250101_000000", "2025-01-01 00:00:00"
RUN2_ID, RUN2_TS = "20250601_000000", "2025-06-01 00:00:00"
TABLE = "src_encounter -> clean_encounter"
PIPE_TABLE = "encounters -> fact_encounters"

# fixed values: the columns of the fact's row hash and of the record diff
HASH_COLS = ["encounter_id", "patient_id", "doctor_id", "dept_id", "billing_amount",
             "length_of_stay", "diagnosis_code"]
COMPARE_COLS = ["patient_id", "doctor_id", "dept_id", "billing_amount", "length_of_stay",
                "diagnosis_code"]
DOUBLE_COLS = {"billing_amount"}
SUM_COLS = ["billing_amount", "length_of_stay"]

FIXTURES = [
    ("src_department", "select r_regionkey as dept_id, r_name as dept_name from region"),
    ("src_doctor", """
        select s_suppkey as doctor_id, s_name as name, cast(s_suppkey % 5 as int) as dept_id from supplier
        union all
        select s_suppkey, s_name, cast(s_suppkey % 5 as int) from supplier where s_suppkey % 7 = 3"""),
    ("src_patient", """
        select c_custkey as patient_id, c_name as name, c_nationkey as nation_id, c_mktsegment as segment
        from customer
        union all
        select c_custkey + 2000000000, c_name, c_nationkey, c_mktsegment from customer
        where c_custkey % 101 = 5"""),
    ("base_encounter", """
        select o_orderkey as encounter_id,
               case when o_orderkey % 701 = 13 then o_custkey + 1000000000 else o_custkey end as patient_id,
               o_orderkey % 10 as doctor_id,
               cast(o_orderkey % 5 as int) as dept_id,
               cast(o_orderdate as date) as encounter_date,
               case when o_orderkey % 499 = 7 then cast(null as double)
                    when o_orderkey % 1009 = 11 then -o_totalprice
                    else o_totalprice end as billing_amount,
               cast(o_orderkey % 16 as int) as length_of_stay,
               o_orderpriority as diagnosis_code
        from orders"""),
    ("src_encounter", """
        select * from base_encounter
        union all
        select * from base_encounter where encounter_id % 997 = 3
        union all
        select encounter_id, patient_id, doctor_id, dept_id, encounter_date, cast(null as double),
               length_of_stay, diagnosis_code
        from base_encounter where encounter_id % 1499 = 17"""),
    ("clean_patient", """
        select patient_id, name, nation_id, segment from (
          select *, row_number() over (partition by name, nation_id, segment order by patient_id) as rn
          from src_patient)
        where rn = 1"""),
    ("clean_encounter", """
        select encounter_id, patient_id, doctor_id, dept_id, encounter_date, billing_amount,
               length_of_stay, diagnosis_code from (
          select *, row_number() over (partition by encounter_id
                                       order by case when billing_amount > 0 and patient_id is not null then 0 else 1 end,
                                                billing_amount asc nulls last, patient_id) as rn
          from src_encounter)
        where rn = 1 and billing_amount > 0 and patient_id in (select patient_id from clean_patient)"""),
    ("incoming_patient", """
        select patient_id, name, nation_id,
               case when patient_id % 307 = 6 then null
                    when patient_id % 53 = 2 then 'CHANGED' else segment end as segment
        from clean_patient where patient_id % 401 <> 9
        union all
        select patient_id + 3000000000, name, nation_id, segment from clean_patient
        where patient_id % 211 = 4"""),
    ("dim_init", """
        select patient_id, name, nation_id, segment,
               row_number() over (order by patient_id) as patient_sk,
               date '2025-01-01' as effective_date, cast(null as date) as end_date, true as is_current
        from clean_patient"""),
    ("changes", """
        select i.patient_id, i.name, i.nation_id, i.segment
        from incoming_patient i left join (select * from dim_init where is_current) c
          on i.patient_id = c.patient_id
        where c.patient_id is null
           or (i.name <> c.name or i.nation_id <> c.nation_id or i.segment <> c.segment)"""),
    ("changes_ns", """
        select i.patient_id, i.name, i.nation_id, i.segment
        from incoming_patient i left join (select * from dim_init where is_current) c
          on i.patient_id = c.patient_id
        where c.patient_id is null
           or (i.name is distinct from c.name or i.nation_id is distinct from c.nation_id
               or i.segment is distinct from c.segment)"""),
    ("dim_apply", """
        select d.patient_id, d.name, d.nation_id, d.segment, d.patient_sk, d.effective_date,
               case when d.is_current and k.patient_id is not null then date '2025-06-01'
                    else d.end_date end as end_date,
               case when d.is_current and k.patient_id is not null then false
                    else d.is_current end as is_current
        from dim_init d left join (select distinct patient_id from changes) k
          on d.patient_id = k.patient_id
        union all
        select patient_id, name, nation_id, segment,
               (select coalesce(max(patient_sk), 0) from dim_init)
                 + row_number() over (order by patient_id),
               date '2025-06-01', cast(null as date), true
        from changes"""),
    ("fact_init", """
        select e.encounter_id, e.patient_id, d.patient_sk, e.doctor_id, e.dept_id,
               cast(year(e.encounter_date) * 10000 + month(e.encounter_date) * 100
                    + day(e.encounter_date) as int) as date_id,
               e.billing_amount, e.length_of_stay, e.diagnosis_code, e.encounter_date
        from clean_encounter e
        left join (select patient_id, patient_sk from dim_init where is_current) d
          on e.patient_id = d.patient_id"""),
    ("fact_apply", """
        select e.encounter_id, e.patient_id, d.patient_sk, e.doctor_id, e.dept_id,
               cast(year(e.encounter_date) * 10000 + month(e.encounter_date) * 100
                    + day(e.encounter_date) as int) as date_id,
               e.billing_amount, e.length_of_stay, e.diagnosis_code, e.encounter_date
        from clean_encounter e
        left join (select patient_id, patient_sk from dim_apply where is_current) d
          on e.patient_id = d.patient_id"""),
    ("diff", """
        select coalesce(s.encounter_id, t.encounter_id) as encounter_id,
               """ + ",\n               ".join(
                   [f"s.{c} as src_{c}" for c in COMPARE_COLS] + [f"t.{c} as tgt_{c}" for c in COMPARE_COLS]) + """
        from src_encounter s full outer join clean_encounter t on s.encounter_id = t.encounter_id
        where """ + "\n           or ".join(f"s.{c} is distinct from t.{c}" for c in COMPARE_COLS)),
]


def _with(body: str) -> str:
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in FIXTURES)
    return f"with {ctes}\n{body}"


def _text(c: str, null_token: str | None) -> str:
    t = f"cast(cast({c} as decimal(38,2)) as varchar)" if c in DOUBLE_COLS else f"cast({c} as varchar)"
    return f"coalesce({t}, '{null_token}')" if null_token is not None else t


def _row_hash(null_token: str | None = None) -> str:
    return "md5(concat_ws('||', " + ", ".join(_text(c, null_token) for c in HASH_COLS) + "))"


def _fp(rel: str, null_token: str | None) -> str:
    return (f"(select cast(sum(cast(('0x' || substr({_row_hash(null_token)}, 1, 15)) as bigint)) "
            f"as decimal(38,0)) from {rel})")


def _sum(rel: str, c: str) -> str:
    return f"(select cast(coalesce(sum(cast({c} as decimal(18,2))), 0) as decimal(38,2)) from {rel})"


def _check(run_id, run_ts, ctype, table, metric, s, t, ok, mismatch) -> str:
    return (f"select '{run_id}' as run_id, timestamp '{run_ts}' as run_ts, '{ctype}' as check_type, "
            f"'{table}' as table_name, '{metric}' as metric_name, cast({s} as varchar) as source_value, "
            f"cast({t} as varchar) as target_value, "
            f"case when {ok} then 'PASS' else 'FAIL' end as status, "
            f"cast({mismatch} as bigint) as mismatch_count from m")


def checks_sql(src: str, tgt: str, run_id: str, run_ts: str, table: str, diff_rel: str | None,
               which=("count", "sum", "hash", "diff"), null_token: str | None = None) -> str:
    """Check rows of ``src`` vs ``tgt`` as a SELECT (uses fixture views; no WITH)."""
    cols = [f"(select count(*) from {src}) as s_rows", f"(select count(*) from {tgt}) as t_rows",
            f"{_fp(src, null_token)} as s_fp", f"{_fp(tgt, null_token)} as t_fp"]
    for i, c in enumerate(SUM_COLS):
        cols += [f"{_sum(src, c)} as s_sum{i}", f"{_sum(tgt, c)} as t_sum{i}"]
    if diff_rel:
        cols.append(f"(select count(*) from {diff_rel}) as n_diff")
    parts = []
    if "count" in which:
        parts.append(_check(run_id, run_ts, "ROW_COUNT", table, "row_count", "s_rows", "t_rows",
                            "s_rows = t_rows", "abs(s_rows - t_rows)"))
    if "sum" in which:
        for i, c in enumerate(SUM_COLS):
            ok = f"abs(s_sum{i} - t_sum{i}) < 0.01"
            parts.append(_check(run_id, run_ts, "COLUMN_SUM", table, f"sum_{c}", f"s_sum{i}", f"t_sum{i}",
                                ok, f"case when {ok} then 0 else 1 end"))
    if "hash" in which:
        ok = "s_fp is not distinct from t_fp"
        parts.append(_check(run_id, run_ts, "COLUMN_HASH", table, "table_fingerprint_md5", "s_fp", "t_fp",
                            ok, f"case when {ok} then 0 else 1 end"))
    if "diff" in which:
        parts.append(_check(run_id, run_ts, "RECORD_DIFF", table, "mismatched_rows", "s_rows", "t_rows",
                            "n_diff = 0", "n_diff"))
    return "select * from (with m as (select " + ", ".join(cols) + ")\n" + "\nunion all\n".join(parts) + ")"


def _clean_checks() -> str:
    return checks_sql("clean_encounter", "clean_encounter", RUN1_ID, RUN1_TS, TABLE, "diff_clean")


def _dirty_checks() -> str:
    return checks_sql("src_encounter", "clean_encounter", RUN2_ID, RUN2_TS, TABLE, "diff")


DIFF_CLEAN = ("select c.encounter_id from clean_encounter c full outer join clean_encounter d "
              "on c.encounter_id = d.encounter_id where "
              + " or ".join(f"c.{x} is distinct from d.{x}" for x in COMPARE_COLS))


def _with_log(body: str) -> str:
    extra = [("diff_clean", DIFF_CLEAN),
             ("check_log", f"{_clean_checks()}\nunion all\n{_dirty_checks()}"),
             ("summary_all", SUMMARY_OF.format(rel="check_log"))]
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in FIXTURES + extra)
    return f"with {ctes}\n{body}"


SUMMARY_OF = """
    select run_id, run_ts, table_name, count(*) as total_checks,
           cast(count(*) filter (where status = 'PASS') as bigint) as passed,
           cast(count(*) filter (where status = 'FAIL') as bigint) as failed,
           cast(coalesce(sum(mismatch_count), 0) as bigint) as total_mismatches,
           case when count(*) filter (where status = 'FAIL') = 0 then 'PASS' else 'FAIL' end
             as overall_status
    from {rel} group by run_id, run_ts, table_name"""

LATEST = "select * from check_log where run_id = (select max(run_id) from check_log)"

# Compact record diff from the reference's row-level pairs: identical rows become one row
# with ``n_rows``; keys with several versions on both sides list their versions instead.
_V = ", ".join(COMPARE_COLS)
_MN = ("select a.encounter_id from "
       f"(select encounter_id, count(distinct ({_V})) as d from src_encounter "
       "where encounter_id is not null group by encounter_id) a join "
       f"(select encounter_id, count(distinct ({_V})) as d from clean_encounter "
       "where encounter_id is not null group by encounter_id) b "
       "on a.encounter_id = b.encounter_id where a.d >= 2 and b.d >= 2")
COMPACT_DIFF = (
    "select encounter_id, " + ", ".join([f"src_{c}" for c in COMPARE_COLS] + [f"tgt_{c}" for c in COMPARE_COLS])
    + ", count(*) as n_rows from diff "
    f"where encounter_id is null or encounter_id not in ({_MN}) group by all "
    "union all select encounter_id, " + ", ".join(f"{c} as src_{c}" for c in COMPARE_COLS) + ", "
    + ", ".join(f"null as tgt_{c}" for c in COMPARE_COLS)
    + f", count(*) as n_rows from src_encounter where encounter_id in ({_MN}) group by all "
    "union all select encounter_id, " + ", ".join(f"null as src_{c}" for c in COMPARE_COLS) + ", "
    + ", ".join(f"{c} as tgt_{c}" for c in COMPARE_COLS)
    + f", count(*) as n_rows from clean_encounter where encounter_id in ({_MN}) group by all")
DETAILS = f"select *, '{RUN2_ID}' as run_id from ({COMPACT_DIFF})"   # all differences of the run
REPORT_COLS = "check_type, table_name, metric_name, source_value, target_value, status, mismatch_count"
FACT_COLS = ("encounter_id, patient_id, patient_sk, doctor_id, dept_id, date_id, billing_amount, "
             "length_of_stay, diagnosis_code")


def _pipeline_sql() -> str:
    extra = [("fact_pipe", f"select {FACT_COLS} from fact_init"),
             ("diff_pipe", "select s.encounter_id from src_encounter s full outer join fact_pipe t "
                           "on s.encounter_id = t.encounter_id where "
                           + " or ".join(f"s.{x} is distinct from t.{x}" for x in COMPARE_COLS)),
             ("checks_pipe", checks_sql("src_encounter", "fact_pipe", RUN1_ID, RUN1_TS, PIPE_TABLE,
                                        "diff_pipe"))]
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in FIXTURES + extra)
    return f"with {ctes}\n" + SUMMARY_OF.format(rel="checks_pipe")


HISTORY_RUNS = ("20250101_000000", "20250601_000000", "20250901_000000", "20251201_000000")
_FOUR_RUNS = " union all ".join(f"select {FACT_COLS}, '{r}' as gold_run_id from {rel}" for r, rel in zip(
    HISTORY_RUNS, ("fact_init", "fact_apply", "fact_apply", "fact_init")))
# gaps and islands: equal rows (with equal copies) of consecutive runs are one interval
_COMPACT_HISTORY = f"""
    select {FACT_COLS}, n_rows, min(gold_run_id) as from_run,
           (select min(r.id) from run_list r where r.i > max(v.i)) as to_run
    from (select *, i - row_number() over (partition by {FACT_COLS}, n_rows order by i) as island
          from (select h.*, r.i from (select {FACT_COLS}, gold_run_id, count(*) as n_rows from four_runs group by all) h
                join run_list r on r.id = h.gold_run_id)) v
    group by {FACT_COLS}, n_rows, island"""


def _with_history(body: str) -> str:
    listed = "select * from (values " + ", ".join(f"({i}, '{r}')" for i, r in enumerate(HISTORY_RUNS)) + ") t(i, id)"
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in FIXTURES + [("four_runs", _FOUR_RUNS), ("run_list", listed)])
    return f"with {ctes}\n{body}"


def _exact_sums_sql() -> str:
    """Exact sums by whole numbers of 2^-70, of which all these values are multiples."""
    unit = "1180591620717411303424.0"                     # 2^70
    whole = lambda x: f"sum(cast(({x}) * {unit} as hugeint))"
    cols = {"price": ("l_extendedprice / 7 + 0.0::double", "l_extendedprice / 7 + 0.000001::double"),
            "tax": ("l_tax / 3", "l_tax / 3"), "tiny": ("0.004::double", "0.001::double")}
    m = ", ".join(f"{whole(a)} as s_{c}, {whole(b)} as t_{c}" for c, (a, b) in cols.items())
    amount = lambda v: f"cast(cast({v} as double) / {unit} as decimal(38,2))"
    parts = []
    for c in cols:
        ok = f"abs(cast(s_{c} - t_{c} as double) / {unit}) < 0.01"
        parts.append(_check(RUN2_ID, RUN2_TS, "COLUMN_SUM", "fine amounts", f"sum_{c}", amount(f"s_{c}"), amount(f"t_{c}"), ok,
                            f"case when {ok} then 0 else 1 end"))
    return f"with m as (select {m} from lineitem)\n" + "\nunion all\n".join(parts)


_DAMAGED = """
    select * exclude (billing_amount, encounter_date),
           case when encounter_id % 503 = 1 then null else billing_amount end as billing_amount,
           case when encounter_id % 607 = 2 then null else encounter_date end as encounter_date
    from src_encounter where encounter_id % 809 <> 3"""


def oracle_sql() -> dict[str, str]:
    q = {
        "ingest_audit": _with("select *, 'encounters.csv' as _source_file from src_encounter"),
        "clean_customer": _with("select * from clean_patient"),
        "clean_supplier": _with("""
            select doctor_id, name, dept_id from (
              select *, row_number() over (partition by doctor_id order by name, dept_id) as rn
              from src_doctor) where rn = 1"""),
        "clean_encounters": _with("select * from clean_encounter"),
        "dedup_lineitem": """
            select * exclude (rn) from (
              select *, row_number() over (
                partition by l_orderkey, l_linenumber
                order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                         l_returnflag, l_linestatus, l_shipdate) as rn
              from lineitem) where rn = 1""",
        "issue_profile": _with("""
            select 'duplicate_rows' as issue, cast(count(*) - count(distinct encounter_id) as bigint) as n
              from src_encounter
            union all select 'null_amount', cast(count(*) filter (where billing_amount is null) as bigint)
              from src_encounter
            union all select 'non_positive_amount', cast(count(*) filter (where billing_amount <= 0) as bigint)
              from src_encounter
            union all select 'orphan_fk', cast(count(*) as bigint) from src_encounter e
              where e.patient_id is not null
                and not exists (select 1 from src_patient p where p.patient_id = e.patient_id)"""),
        "scd2_initial": _with("select * from dim_init"),
        "scd2_changes": _with("select * from changes"),
        "scd2_changes_null_safe": _with("select * from changes_ns"),
        "scd2_apply": _with("select * from dim_apply"),
        "scd2_version_counts": _with(
            "select count(*) filter (where is_current) as current_rows, count(*) as total_rows from dim_apply"),
        "dim_date": _with("""
            select cast(year(d) * 10000 + month(d) * 100 + day(d) as int) as date_id, d as date,
                   cast(year(d) as int) as year, cast(month(d) as int) as month,
                   cast(quarter(d) as int) as quarter, dayname(d) as day_of_week
            from (select distinct encounter_date as d from clean_encounter)"""),
        "fact_build": _with(f"select {FACT_COLS} from fact_apply"),
        "fact_history": _with(f"""
            select {FACT_COLS}, cast(null as date) as encounter_date,
                   timestamp '{RUN1_TS}' as gold_run_ts, '{RUN1_ID}' as gold_run_id from fact_init
            union all
            select {FACT_COLS}, encounter_date,
                   timestamp '{RUN2_TS}' as gold_run_ts, '{RUN2_ID}' as gold_run_id from fact_apply"""),
        "number_rows": "select o_orderkey, row_number() over (order by o_orderkey) as sk from orders",
        "recon_row_count": _with(checks_sql("src_encounter", "clean_encounter", RUN2_ID, RUN2_TS, TABLE,
                                            None, ("count",))),
        "recon_column_sum": _with(checks_sql("src_encounter", "clean_encounter", RUN2_ID, RUN2_TS, TABLE,
                                             None, ("sum",))),
        "recon_row_hash": _with(f"select encounter_id, {_row_hash()} as row_hash from src_encounter"),
        "recon_fingerprint": _with(checks_sql("src_encounter", "clean_encounter", RUN2_ID, RUN2_TS, TABLE,
                                              None, ("hash",))),
        "recon_fingerprint_strict": _with(checks_sql("src_encounter", "clean_encounter", RUN2_ID, RUN2_TS,
                                                     TABLE, None, ("hash",), null_token="\\N")),
        "recon_record_diff": _with(COMPACT_DIFF),
        "recon_record_diff_check": _with(checks_sql("src_encounter", "clean_encounter", RUN2_ID, RUN2_TS,
                                                    TABLE, "diff", ("diff",))),
        "recon_diff_details": _with(DETAILS),
        "recon_checks": _with(_dirty_checks()),
        "recon_checks_clean": _with_log("select * from (" + _clean_checks() + ")"),
        "results_latest": _with_log(LATEST),
        "results_summary": _with_log(SUMMARY_OF.format(rel=f"({LATEST})")),
        "results_append_new": _with_log("select * from summary_all"),
        "results_dedup": _with_log("""
            select * exclude (rn) from (
              select *, row_number() over (partition by run_id, table_name
                                           order by run_ts desc, total_checks, passed, failed,
                                                    total_mismatches, overall_status) as rn
              from (select * from summary_all
                    union all select * from summary_all
                    union all select run_id, run_ts + interval 1 hour, table_name, total_checks, passed,
                                     failed, cast(0 as bigint), overall_status from summary_all))
            where rn = 1"""),
        "report_runs": _with_log("select distinct run_id, run_ts from summary_all order by run_ts desc"),
        "report_run_summary": _with_log(
            f"select * from summary_all where run_id = '{RUN2_ID}' order by run_ts desc"),
        "report_checks": _with_log(
            f"select {REPORT_COLS} from check_log where run_id = '{RUN2_ID}' order by check_type"),
        "report_first_diffs": _with(
            f"select *, '{RUN2_ID}' as run_id from diff order by " + ", ".join(
                f"{c} asc nulls last" for c in ["encounter_id", *[f"src_{c}" for c in COMPARE_COLS], *[f"tgt_{c}" for c in COMPARE_COLS]])
            + " limit 50"),
        "report_diffs": _with(f"select * from ({DETAILS}) where run_id = '{RUN2_ID}'"),
        "report_trend": _with_log("select run_id, run_ts, total_checks, passed, failed, total_mismatches, "
                                  "overall_status from summary_all order by run_ts desc"),
        "export_roundtrip": _with_log(
            f"select {REPORT_COLS} from check_log where run_id = '{RUN2_ID}'"),
        "pipeline_summary": _pipeline_sql(),
        "recon_bucket_diff": _with(COMPACT_DIFF),
        "recon_exact_sum": _exact_sums_sql(),
        "scd2_apply_stored": _with("select * from dim_apply"),
        "fact_history_compact": _with_history(_COMPACT_HISTORY),
        "fact_history_rebuilt": _with_history("select * from four_runs"),
        "rerun_clean_details": _with(f"select *, '{RUN1_ID}' as run_id from ({COMPACT_DIFF})"),
        "ingest_incremental": _with("select *, cast(encounter_id % 2 + 1 as int) as _load from src_encounter"),
        "ingest_rejects": _with("""
            select 'malformed' as reason, null::varchar as column_name, count(*) as n_rows from src_encounter where encounter_id % 809 = 3
            having count(*) > 0
            union all select 'cast', 'billing_amount', count(*) from src_encounter where encounter_id % 503 = 1 and encounter_id % 809 <> 3
            having count(*) > 0
            union all select 'cast', 'encounter_date', count(*) from src_encounter where encounter_id % 607 = 2 and encounter_id % 809 <> 3
            having count(*) > 0"""),
        "ingest_rescued": _with(_DAMAGED),
    }
    q["results_dedup_stored"] = q["results_dedup"]
    return q
