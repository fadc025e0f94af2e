"""Registered queries: one per operator group of the survey, each ``(spark, sf_dir) -> DataFrame``
over the given tables (or inputs Spark derives from them).  ``lakecheck.plans.oracle`` holds
the matching DuckDB SQL for each name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecheck.operators import bucket_diff, dims, facts, history, quality, recon, results
from lakecheck.operators.numbering import number_rows
from lakecheck.plans import pipeline
from lakecheck.session import scratch_path
from lakecheck.sinks import keyed, runs, versioned, writers
from lakecheck.sources import fixtures as fx
from lakecheck.sources import ledger, rejects
from lakecheck.sources.csv import ingest, read_csv
from lakecheck.sources.tables import load

KEY = "patient_id"
TABLE = "src_encounter -> clean_encounter"
SPEC = recon.CheckSpec(key="encounter_id", sum_cols=("billing_amount", "length_of_stay"),
                       hash_cols=tuple(pipeline.HASH_COLUMNS),
                       compare_cols=tuple(pipeline.COMPARE_COLUMNS), table_name=TABLE)
STRICT_SPEC = recon.CheckSpec(key=SPEC.key, sum_cols=SPEC.sum_cols, hash_cols=SPEC.hash_cols,
                              compare_cols=SPEC.compare_cols, table_name=TABLE, null_token="\\N")


# ---------------------------------------------------------------- shared derivations

def _dim_init(spark, sf):
    return dims.scd2_init(fx.clean_patient(spark, sf), KEY, fx.FIRST_LOAD, "patient_sk")


def _dim_apply(spark, sf):
    return dims.scd2_apply(_dim_init(spark, sf), fx.incoming_patient(spark, sf), KEY,
                           fx.PATIENT_ATTRS, fx.SECOND_LOAD, "patient_sk")


def _fact(spark, sf, dim, extra=()):
    return facts.build_fact(fx.clean_encounter(spark, sf), dim, KEY, "encounter_date",
                            pipeline.FACT_COLUMNS + list(extra), "patient_sk")


def _diff(spark, sf):
    return recon.record_diff(fx.src_encounter(spark, sf), fx.clean_encounter(spark, sf),
                             SPEC.key, SPEC.compare_cols)


def _checks_dirty(spark, sf):
    return recon.run_checks(fx.src_encounter(spark, sf), fx.clean_encounter(spark, sf), SPEC,
                            fx.RUN2_ID, fx.RUN2_TS)


def _checks_clean(spark, sf):
    c = fx.clean_encounter(spark, sf)
    return recon.run_checks(c, c, SPEC, fx.RUN1_ID, fx.RUN1_TS)


def _check_log(spark, sf):
    """The check log as the reports see it: both runs stored in a run-partitioned dataset
    in the shared folder and read back (a stored table, not a recomputed plan)."""
    path = scratch_path(spark, "checks")
    # both runs' rows in one run-partitioned write (one job; the fixtures' scans are shared)
    writers.write_runs(_checks_clean(spark, sf).unionByName(_checks_dirty(spark, sf)), path)
    return writers.read_runs(spark, path, recon.CHECK_SCHEMA)


def _details_of(spark, sf):
    return _diff(spark, sf).withColumn("run_id", F.lit(fx.RUN2_ID))


def _details(spark, sf):
    """Diff details of the dirty run, stored per run id and read back."""
    path = scratch_path(spark, "details")
    writers.write_runs(_details_of(spark, sf), path)
    return writers.read_runs(spark, path)


def _summary_all(spark, sf):
    return results.summarize(_check_log(spark, sf))


# ---------------------------------------------------------------- queries

def ingest_audit(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "raw")
    writers.export_csv(fx.src_encounter(spark, sf), f"{base}/encounters.csv")
    raw = ingest(spark, base, {"encounters": "encounters.csv"},
                 {"encounters": pipeline.ENCOUNTER_SCHEMA}, ingestion_ts=fx.RUN1_TS)
    return raw["encounters"].drop("_ingestion_ts")


def clean_customer(spark, sf):
    return fx.clean_patient(spark, sf)


def clean_supplier(spark, sf):
    return quality.clean_small_dim(fx.src_doctor(spark, sf), "doctor_id", fx.DOCTOR_COLUMNS)


def clean_encounters(spark, sf):
    return fx.clean_encounter(spark, sf)


def dedup_lineitem(spark, sf):
    return quality.dedup(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def issue_profile(spark, sf):
    return quality.profile(fx.src_encounter(spark, sf), "encounter_id", "billing_amount",
                           KEY, fx.src_patient(spark, sf))


def scd2_initial(spark, sf):
    return _dim_init(spark, sf)


def scd2_changes(spark, sf):
    return dims.scd2_changes(fx.incoming_patient(spark, sf), dims.current(_dim_init(spark, sf)),
                             KEY, fx.PATIENT_ATTRS)


def scd2_changes_null_safe(spark, sf):
    return dims.scd2_changes(fx.incoming_patient(spark, sf), dims.current(_dim_init(spark, sf)),
                             KEY, fx.PATIENT_ATTRS, null_safe=True)


def scd2_apply(spark, sf):
    return _dim_apply(spark, sf)


def scd2_version_counts(spark, sf):
    return dims.version_counts(_dim_apply(spark, sf))


def dim_date(spark, sf):
    return dims.date_dim(fx.clean_encounter(spark, sf), "encounter_date")


def fact_build(spark, sf):
    return _fact(spark, sf, _dim_apply(spark, sf))


def fact_history(spark, sf):
    path = scratch_path(spark, "fact_history")
    writers.write_runs(facts.snapshot(_fact(spark, sf, _dim_init(spark, sf)), fx.RUN1_TS, fx.RUN1_ID),
                       path, "gold_run_id")
    # the second run's fact carries one more column: the history schema evolves
    second = _fact(spark, sf, _dim_apply(spark, sf), extra=["encounter_date"])
    writers.write_runs(facts.snapshot(second, fx.RUN2_TS, fx.RUN2_ID), path, "gold_run_id")
    return writers.read_runs(spark, path, run_col="gold_run_id")


def number_orders(spark, sf):
    return number_rows(load(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], "sk")


def recon_row_count(spark, sf):
    return recon.row_count_check(fx.src_encounter(spark, sf), fx.clean_encounter(spark, sf), SPEC,
                                 fx.RUN2_ID, fx.RUN2_TS)


def recon_column_sum(spark, sf):
    return recon.column_sum_check(fx.src_encounter(spark, sf), fx.clean_encounter(spark, sf), SPEC,
                                  fx.RUN2_ID, fx.RUN2_TS)


def recon_row_hash(spark, sf):
    return recon.row_hashes(fx.src_encounter(spark, sf), SPEC.key, SPEC.hash_cols, SPEC.decimal_scale)


def recon_fingerprint(spark, sf):
    return recon.fingerprint_check(fx.src_encounter(spark, sf), fx.clean_encounter(spark, sf), SPEC,
                                   fx.RUN2_ID, fx.RUN2_TS)


def recon_fingerprint_strict(spark, sf):
    return recon.fingerprint_check(fx.src_encounter(spark, sf), fx.clean_encounter(spark, sf),
                                   STRICT_SPEC, fx.RUN2_ID, fx.RUN2_TS)


def recon_record_diff(spark, sf):
    """Compact record diff: one row per differing (key, source version, target version) with
    the number of reference rows it stands for (``n_rows``)."""
    return _diff(spark, sf)


def recon_record_diff_check(spark, sf):
    return recon.record_diff_check(fx.src_encounter(spark, sf), fx.clean_encounter(spark, sf), SPEC,
                                   fx.RUN2_ID, fx.RUN2_TS)


def recon_diff_details(spark, sf):
    return _details_of(spark, sf)


def recon_checks(spark, sf):
    return _checks_dirty(spark, sf)


def recon_checks_clean(spark, sf):
    return _checks_clean(spark, sf)


def results_latest(spark, sf):
    return results.latest(_check_log(spark, sf))


def results_summary(spark, sf):
    return results.summarize(results.latest(_check_log(spark, sf)))


def results_append_new(spark, sf):
    log = _check_log(spark, sf)
    first = results.summarize(log.filter(F.col("run_id") == fx.RUN1_ID))
    table = spark.createDataFrame([], results.SUMMARY_SCHEMA)
    table = results.append_new(table, first.select(*results.SUMMARY_COLUMNS))
    table = results.append_new(table, first.select(*results.SUMMARY_COLUMNS))  # same run: no-op
    latest = results.summarize(results.latest(log)).select(*results.SUMMARY_COLUMNS)
    return results.append_new(table, latest)


def results_dedup(spark, sf):
    s = _summary_all(spark, sf)
    restamped = s.withColumn("run_ts", F.col("run_ts") + F.expr("INTERVAL 1 HOUR")) \
                 .withColumn("total_mismatches", F.lit(0).cast("bigint"))
    return results.dedup_summary(s.unionByName(s).unionByName(restamped))


def report_runs(spark, sf):
    return results.runs(_summary_all(spark, sf))


def report_run_summary(spark, sf):
    return results.run_summary(_summary_all(spark, sf), fx.RUN2_ID)


def report_checks(spark, sf):
    return results.run_checks_view(_check_log(spark, sf), fx.RUN2_ID)


def report_diffs(spark, sf):
    return results.run_diffs(_details(spark, sf), fx.RUN2_ID, SPEC.key)


def report_first_diffs(spark, sf):
    """The first 50 row-level differences in key order, as a run's report page shows them."""
    v = recon.versions(fx.src_encounter(spark, sf), fx.clean_encounter(spark, sf), [SPEC.key, *SPEC.compare_cols])
    return recon.details_of_versions(v, SPEC.key, SPEC.compare_cols, fx.RUN2_ID, 50)


def report_trend(spark, sf):
    return results.trend(_summary_all(spark, sf))


def export_roundtrip(spark, sf):
    path = scratch_path(spark, "export")
    view = results.run_checks_view(_check_log(spark, sf), fx.RUN2_ID)
    writers.export_csv(view, path)
    schema = ("check_type string, table_name string, metric_name string, source_value string, "
              "target_value string, status string, mismatch_count bigint")
    return read_csv(spark, path, schema)


def stage_raw_files(spark: SparkSession, sf: str) -> str:
    """Write the derived raw inputs as the four CSV files a run ingests."""
    base = scratch_path(spark, "raw")
    sources = {"departments": fx.src_department, "doctors": fx.src_doctor,
               "patients": fx.src_patient, "encounters": fx.src_encounter}
    pipeline.run_together(*[lambda n=n, f=f: writers.export_csv(f(spark, sf), f"{base}/{n}.csv")
                            for n, f in sources.items()])
    return base


def pipeline_summary(spark, sf):
    raw = stage_raw_files(spark, sf)
    out = pipeline.run(spark, raw, scratch_path(spark, "lake"), fx.RUN1_ID, fx.RUN1_TS)
    return out["run_summary"]


# ---------------------------------------------------------------- stored tables and incremental work

DIM_BUCKETS = 32


def recon_bucket_diff(spark, sf):
    """The compact record diff, found through the tree of bucket fingerprints over the two stored tables."""
    src = writers.materialize(fx.src_encounter(spark, sf), scratch_path(spark, "src"))
    tgt = writers.materialize(fx.clean_encounter(spark, sf), scratch_path(spark, "tgt"))
    return bucket_diff.bucket_diff(src, tgt, SPEC.key, SPEC.compare_cols)


def _fine_amounts(spark, sf, price_shift: float, tiny: float):
    line = load(spark, sf, "lineitem")
    return line.select(F.col("l_orderkey").alias("line_id"), (F.col("l_extendedprice") / 7 + F.lit(price_shift)).alias("price"),
                       (F.col("l_tax") / 3).alias("tax"), F.lit(tiny).alias("tiny"))


FINE_SPEC = recon.CheckSpec(key="line_id", sum_cols=("price", "tax", "tiny"), hash_cols=("line_id",), compare_cols=("price",),
                            table_name="fine amounts")


def recon_exact_sum(spark, sf):
    """Sums of doubles with more than two decimals, compared by their exact difference: a shift of a millionth and of three
    thousandths a row, and an equal column."""
    return recon.column_sum_check(_fine_amounts(spark, sf, 0.0, 0.004), _fine_amounts(spark, sf, 1e-6, 0.001), FINE_SPEC,
                                  fx.RUN2_ID, fx.RUN2_TS)


def scd2_apply_stored(spark, sf):
    """``scd2_apply`` on a dimension stored by key hash: only the buckets with changes are rewritten."""
    path = scratch_path(spark, "dim")
    keyed.write(_dim_init(spark, sf), path, KEY, DIM_BUCKETS)
    dims.scd2_update(spark, path, fx.incoming_patient(spark, sf), KEY, fx.PATIENT_ATTRS, fx.SECOND_LOAD, "patient_sk")
    return keyed.open_(spark, path).drop(keyed.BUCKET)


def results_dedup_stored(spark, sf):
    """``results_dedup`` on a stored summary that is replaced by a version of itself."""
    s, path = _summary_all(spark, sf), scratch_path(spark, "summary")
    restamped = s.withColumn("run_ts", F.col("run_ts") + F.expr("INTERVAL 1 HOUR")) \
                 .withColumn("total_mismatches", F.lit(0).cast("bigint"))
    versioned.replace(s.unionByName(s).unionByName(restamped), path)
    versioned.replace(results.dedup_summary(versioned.read(spark, path)), path)
    return versioned.read(spark, path)


def _history_path(spark, sf):
    """A change-only history of four runs: the first load, the second, the second again, and back to the first."""
    first = writers.materialize(_fact(spark, sf, _dim_init(spark, sf)), scratch_path(spark, "fact"))
    second = writers.materialize(_fact(spark, sf, _dim_apply(spark, sf)), scratch_path(spark, "fact"))
    path = scratch_path(spark, "history")
    for run_id, snapshot in zip(fx.HISTORY_RUNS, (first, second, second, first)):
        history.append_run(spark, path, snapshot, run_id)
    return path


def fact_history_compact(spark, sf):
    return history.read(spark, _history_path(spark, sf))


def fact_history_rebuilt(spark, sf):
    """Every run's fact, rebuilt from the change-only history."""
    path = _history_path(spark, sf)
    return history.copies(history.expand(history.read(spark, path), history.run_ids(spark, path), "gold_run_id"))


def rerun_clean_details(spark, sf):
    """Diff details of two dirty runs, the second of which was run again without differences."""
    path = scratch_path(spark, "details")
    dirty = writers.materialize(_diff(spark, sf), scratch_path(spark, "diff"))
    clean = fx.clean_encounter(spark, sf)
    runs.write_run(dirty, path, fx.RUN1_ID)
    runs.write_run(dirty, path, fx.RUN2_ID)
    runs.write_run(recon.record_diff(clean, clean, SPEC.key, SPEC.compare_cols), path, fx.RUN2_ID)
    return writers.read_runs(spark, path)


def ingest_incremental(spark, sf):
    """Two loads of a growing folder, the first repeated; every row with the number of its load."""
    base, out = scratch_path(spark, "raw"), scratch_path(spark, "raw_table")
    rows = fx.src_encounter(spark, sf)
    for odd in (0, 1):
        rows.where(F.col("encounter_id") % 2 == odd).write.mode("append").option("header", "true").csv(base)
        ledger.ingest_new(spark, base, out, pipeline.ENCOUNTER_SCHEMA)
        ledger.ingest_new(spark, base, out, pipeline.ENCOUNTER_SCHEMA)          # nothing new: no-op
    return ledger.read(spark, out).drop(ledger.PATH)


def ingest_rejects(spark, sf):
    """Rejects of a file with values that are no number or date and lines cut short, by reason and column."""
    path = scratch_path(spark, "raw")
    fx.damaged_lines(spark, sf).write.text(path)
    return rejects.profile(rejects.rejects(rejects.read_text(spark, path, pipeline.ENCOUNTER_SCHEMA, header=False), pipeline.ENCOUNTER_SCHEMA))


def ingest_rescued(spark, sf):
    """The typed rows of that file: whole lines, values that do not fit as NULL."""
    path = scratch_path(spark, "raw")
    fx.damaged_lines(spark, sf).write.text(path)
    return rejects.typed(rejects.read_text(spark, path, pipeline.ENCOUNTER_SCHEMA, header=False), pipeline.ENCOUNTER_SCHEMA)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_audit": ingest_audit,
    "clean_customer": clean_customer,
    "clean_supplier": clean_supplier,
    "clean_encounters": clean_encounters,
    "dedup_lineitem": dedup_lineitem,
    "issue_profile": issue_profile,
    "scd2_initial": scd2_initial,
    "scd2_changes": scd2_changes,
    "scd2_changes_null_safe": scd2_changes_null_safe,
    "scd2_apply": scd2_apply,
    "scd2_version_counts": scd2_version_counts,
    "dim_date": dim_date,
    "fact_build": fact_build,
    "fact_history": fact_history,
    "number_rows": number_orders,
    "recon_row_count": recon_row_count,
    "recon_column_sum": recon_column_sum,
    "recon_row_hash": recon_row_hash,
    "recon_fingerprint": recon_fingerprint,
    "recon_fingerprint_strict": recon_fingerprint_strict,
    "recon_record_diff": recon_record_diff,
    "recon_record_diff_check": recon_record_diff_check,
    "recon_diff_details": recon_diff_details,
    "recon_checks": recon_checks,
    "recon_checks_clean": recon_checks_clean,
    "results_latest": results_latest,
    "results_summary": results_summary,
    "results_append_new": results_append_new,
    "results_dedup": results_dedup,
    "report_runs": report_runs,
    "report_run_summary": report_run_summary,
    "report_checks": report_checks,
    "report_diffs": report_diffs,
    "report_trend": report_trend,
    "report_first_diffs": report_first_diffs,
    "export_roundtrip": export_roundtrip,
    "pipeline_summary": pipeline_summary,
    "recon_bucket_diff": recon_bucket_diff,
    "recon_exact_sum": recon_exact_sum,
    "scd2_apply_stored": scd2_apply_stored,
    "results_dedup_stored": results_dedup_stored,
    "fact_history_compact": fact_history_compact,
    "fact_history_rebuilt": fact_history_rebuilt,
    "rerun_clean_details": rerun_clean_details,
    "ingest_incremental": ingest_incremental,
    "ingest_rejects": ingest_rejects,
    "ingest_rescued": ingest_rescued,
}
