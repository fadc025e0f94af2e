"""End-to-end run: raw CSV -> raw tables -> cleaned tables -> star schema -> checks -> summary.

Each layer is written as Parquet under ``out_dir`` and read back before the next layer
starts, like the reference's table-per-notebook flow: lineage stays short, a lost executor
only recomputes the current layer, and the reports read files.  Run-scoped outputs (fact
history, check log, diff details, summary, rejects, manifest) have a partition per run id that a
re-run replaces whole, also by no rows, and a run filter prunes files.  The patient dimension is
stored in partitions by the hash of its key; an update rewrites those that it changes.  The manifest
has every dataset's rows as written, and is written last: a run that is not in it did not finish.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecheck.operators import dims, facts, quality, recon, results
from lakecheck.session import scratch_path
from lakecheck.sinks import keyed, runs, writers
from lakecheck.sources import rejects
from lakecheck.sources.csv import add_lineage

ENCOUNTER_SCHEMA = T.StructType([
    T.StructField("encounter_id", T.LongType()), T.StructField("patient_id", T.LongType()),
    T.StructField("doctor_id", T.LongType()), T.StructField("dept_id", T.IntegerType()),
    T.StructField("encounter_date", T.DateType()), T.StructField("billing_amount", T.DoubleType()),
    T.StructField("length_of_stay", T.IntegerType()), T.StructField("diagnosis_code", T.StringType()),
])
PATIENT_SCHEMA = T.StructType([
    T.StructField("patient_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("nation_id", T.IntegerType()), T.StructField("segment", T.StringType()),
])
DOCTOR_SCHEMA = T.StructType([
    T.StructField("doctor_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("dept_id", T.IntegerType()),
])
DEPARTMENT_SCHEMA = T.StructType([
    T.StructField("dept_id", T.IntegerType()), T.StructField("dept_name", T.StringType()),
])

# fixed values: the columns of the fact, of its row hash and of the record diff
FACT_COLUMNS = ["encounter_id", "patient_id", "patient_sk", "doctor_id", "dept_id", "date_id",
                "billing_amount", "length_of_stay", "diagnosis_code"]
HASH_COLUMNS = ["encounter_id", "patient_id", "doctor_id", "dept_id", "billing_amount",
                "length_of_stay", "diagnosis_code"]
COMPARE_COLUMNS = ["patient_id", "doctor_id", "dept_id", "billing_amount", "length_of_stay",
                   "diagnosis_code"]


@dataclass(frozen=True)
class PipelineSpec:
    files: dict = field(default_factory=lambda: {
        "departments": "departments.csv", "doctors": "doctors.csv",
        "patients": "patients.csv", "encounters": "encounters.csv"})
    schemas: dict = field(default_factory=lambda: {
        "departments": DEPARTMENT_SCHEMA, "doctors": DOCTOR_SCHEMA,
        "patients": PATIENT_SCHEMA, "encounters": ENCOUNTER_SCHEMA})
    dept_key: str = "dept_id"
    doctor_key: str = "doctor_id"
    patient_key: str = "patient_id"
    patient_attrs: tuple = ("name", "nation_id", "segment")
    enc_key: str = "encounter_id"
    enc_fk: str = "patient_id"
    enc_amount: str = "billing_amount"
    enc_date: str = "encounter_date"
    sk_col: str = "patient_sk"
    initial_date: str = "2025-01-01"
    dim_buckets: int = 64          # partitions of the patient dimension; an update rewrites those that it touches
    check: recon.CheckSpec = recon.CheckSpec(
        key="encounter_id", sum_cols=("billing_amount", "length_of_stay"),
        hash_cols=tuple(HASH_COLUMNS), compare_cols=tuple(COMPARE_COLUMNS),
        table_name="encounters -> fact_encounters")


# fixed values: a layout with more attributes of doctors and patients; patients are compared by all of theirs
CLINIC_SCHEMAS = {
    "departments": T.StructType([T.StructField("dept_id", T.IntegerType()), T.StructField("dept_name", T.StringType()),
                                 T.StructField("building", T.StringType())]),
    "doctors": T.StructType([T.StructField("doctor_id", T.IntegerType()), T.StructField("name", T.StringType()),
                             T.StructField("specialization", T.StringType()), T.StructField("dept_id", T.IntegerType())]),
    "patients": T.StructType([T.StructField("patient_id", T.IntegerType()), T.StructField("name", T.StringType()),
                              T.StructField("age", T.IntegerType()), T.StructField("gender", T.StringType()),
                              T.StructField("blood_group", T.StringType()), T.StructField("city", T.StringType())]),
    "encounters": T.StructType([T.StructField(f.name, T.IntegerType() if isinstance(f.dataType, T.LongType) else f.dataType)
                                for f in ENCOUNTER_SCHEMA.fields]),
}
CLINIC_SPEC = PipelineSpec(schemas=CLINIC_SCHEMAS, patient_attrs=("name", "age", "gender", "blood_group", "city"))


def run_together(*actions):
    """Run independent actions (writes of different datasets) as concurrent Spark jobs, one
    driver thread each, and return their results in order.  The scheduler interleaves their
    tasks, so small layers do not leave executors idle while a large one runs."""
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = [pool.submit(a) for a in actions]
        return [f.result() for f in futures]


LAYER_TABLES = {  # layer -> {dataset path under out_dir: catalog table name}
    "bronze": {"bronze/departments": "raw_departments", "bronze/doctors": "raw_doctors",
               "bronze/patients": "raw_patients", "bronze/encounters": "raw_encounters"},
    "silver": {"silver/departments": "clean_departments", "silver/doctors": "clean_doctors",
               "silver/patients": "clean_patients", "silver/encounters": "clean_encounters"},
    "gold": {"gold/dim_department": "dim_department", "gold/dim_doctor": "dim_doctor",
             "gold/dim_patient": "dim_patient", "gold/dim_date": "dim_date", "gold/fact": "fact",
             "gold/fact_history": "fact_history"},
    "results": {"results/checks": "checks", "results/diff_details": "diff_details",
                "results/summary": "summary", "results/rejects": "rejects", "results/manifest": "manifest"},
}
PARTITIONED = {"gold/dim_patient", "gold/fact_history", "results/checks", "results/diff_details", "results/summary",
               "results/rejects", "results/manifest"}


def register_layers(spark: SparkSession, out_dir: str, catalog: dict[str, str]) -> None:
    """Register the written datasets as catalog tables, ``{layer: database}``."""
    for layer, db in catalog.items():
        writers.ensure_database(spark, db)
        for rel, table in LAYER_TABLES[layer].items():
            writers.register_table(spark, f"`{db}`.`{table}`", f"{out_dir.rstrip('/')}/{rel}",
                                   rel in PARTITIONED)


def run(spark: SparkSession, raw_path: str, out_dir: str, run_id: str, run_ts: str,
        as_of: str | None = None, spec: PipelineSpec = PipelineSpec(),
        previous_dim: DataFrame | None = None,
        catalog: dict[str, str] | None = None, reset_dim: bool = False) -> dict[str, DataFrame]:
    """Run every layer once for ``run_id``.  A patient dimension that exists under ``out_dir`` (or is
    given as ``previous_dim``) gets an SCD2 update on ``as_of``; without one, or with ``reset_dim``,
    the dimension is a first load.
    ``catalog`` ({"bronze"|"silver"|"gold"|"results": database}) also registers the written
    datasets as external catalog tables for SQL users."""
    out = out_dir.rstrip("/")
    counts: dict[str, Observation | int] = {}

    def mat(df: DataFrame, path: str) -> DataFrame:
        """Write a layer (its row count observed during the write) and read it back."""
        observed_df, counts[path[len(out) + 1:]] = writers.observed(df)
        return writers.materialize(observed_df, path)

    def mat_run(df: DataFrame, rel: str, run_col: str = "run_id") -> None:
        """Write this run's rows of a run-scoped dataset, counted."""
        observed_df, counts[rel] = writers.observed(df)
        runs.write_run(observed_df, f"{out}/{rel}", run_id, run_col)

    # every field is read as text: rows and values that do not fit their types are kept as rejects
    names = list(spec.files)
    texts = {t: rejects.read_text(spark, f"{raw_path.rstrip('/')}/{spec.files[t]}", spec.schemas[t]) for t in names}
    refused = None
    for t in names:
        r = rejects.rejects(texts[t], spec.schemas[t]).select(F.lit(t).alias("table_name"), *rejects.REJECT_COLUMNS)
        refused = r if refused is None else refused.unionByName(r)
    *made, _ = run_together(
        *[lambda t=t: mat(add_lineage(rejects.typed(texts[t], spec.schemas[t], malformed=True), spec.files[t], run_ts),
                          f"{out}/bronze/{t}") for t in names],
        lambda: mat_run(refused, "results/rejects"))
    bronze = dict(zip(names, made))

    dep_cols = [f.name for f in spec.schemas["departments"].fields]
    doc_cols = [f.name for f in spec.schemas["doctors"].fields]
    pat_cols = [f.name for f in spec.schemas["patients"].fields]
    enc_cols = [f.name for f in spec.schemas["encounters"].fields]

    def patients_then_encounters():
        pat = mat(quality.clean_entity(bronze["patients"], spec.patient_key, list(spec.patient_attrs),
                                       pat_cols), f"{out}/silver/patients")
        enc = mat(quality.clean_fact(bronze["encounters"], spec.enc_key, pat, spec.enc_fk,
                                     spec.enc_amount, enc_cols), f"{out}/silver/encounters")
        return pat, enc

    dep, doc, (pat, enc) = run_together(
        lambda: mat(quality.clean_small_dim(bronze["departments"], spec.dept_key, dep_cols),
                    f"{out}/silver/departments"),
        lambda: mat(quality.clean_small_dim(bronze["doctors"], spec.doctor_key, doc_cols),
                    f"{out}/silver/doctors"),
        patients_then_encounters)
    silver = {"departments": dep, "doctors": doc, "patients": pat, "encounters": enc}

    dim_path = f"{out}/gold/dim_patient"
    keyed.recover(spark, dim_path)
    stored = previous_dim is None and not reset_dim and writers.path_exists(spark, dim_path)
    if stored and not keyed.is_keyed(spark, dim_path):       # laid out otherwise: read whole and laid out anew
        previous_dim, stored = spark.read.parquet(dim_path), False
    fact_cols = FACT_COLUMNS if spec.sk_col == "patient_sk" else [
        spec.sk_col if c == "patient_sk" else c for c in FACT_COLUMNS]

    def patient_dim_then_fact():
        as_of_date, attrs = as_of or run_ts[:10], list(spec.patient_attrs)
        if stored:
            dims.scd2_update(spark, dim_path, silver["patients"], spec.patient_key, attrs, as_of_date, spec.sk_col)
        else:
            if previous_dim is None:
                nxt = dims.scd2_init(silver["patients"], spec.patient_key, spec.initial_date, spec.sk_col)
            else:
                # the next version may be computed from the files it replaces: written elsewhere first
                nxt = writers.materialize(dims.scd2_apply(previous_dim.drop(keyed.BUCKET), silver["patients"], spec.patient_key,
                                                          attrs, as_of_date, spec.sk_col), scratch_path(spark, "dim-patient"))
            keyed.write(nxt, dim_path, spec.patient_key, spec.dim_buckets)
        dim_patient = keyed.open_(spark, dim_path).drop(keyed.BUCKET)
        counts["gold/dim_patient"] = dim_patient.count()                    # from the files' footers
        fact = mat(facts.build_fact(silver["encounters"], dim_patient, spec.patient_key,
                                    spec.enc_date, fact_cols, spec.sk_col), f"{out}/gold/fact")
        mat_run(facts.snapshot(fact, run_ts, run_id), "gold/fact_history", "gold_run_id")
        return dim_patient, fact

    (dim_patient, fact), dim_dep, dim_doc, dim_date = run_together(
        patient_dim_then_fact,
        lambda: mat(silver["departments"], f"{out}/gold/dim_department"),
        lambda: mat(silver["doctors"], f"{out}/gold/dim_doctor"),
        lambda: mat(dims.date_dim(silver["encounters"], spec.enc_date), f"{out}/gold/dim_date"))
    gold = {"dim_department": dim_dep, "dim_doctor": dim_doc, "dim_patient": dim_patient,
            "dim_date": dim_date, "fact": fact}

    src, tgt, cs = bronze["encounters"], gold["fact"], spec.check
    # both sides grouped once into versions; they feed the check log and the details, so
    # write them once as Parquet in the shared scratch folder (compressed and columnar, unlike
    # an RDD checkpoint) instead of shuffling both tables twice
    v = writers.materialize(recon.versions(src, tgt, recon.check_columns(cs)),
                            scratch_path(spark, f"versions-{run_id}"))
    dv = recon.narrow_versions(v, [cs.key, *cs.compare_cols])
    run_together(
        lambda: mat_run(recon.run_checks(src, tgt, cs, run_id, run_ts, v=v), "results/checks"),
        lambda: mat_run(recon.diff_of_versions(dv, cs.key, cs.compare_cols), "results/diff_details"))
    checks = writers.read_runs(spark, f"{out}/results/checks", recon.CHECK_SCHEMA)

    # the summary of this run, whatever other runs are stored; a re-run replaces its own rows as the checks do
    summary_path = f"{out}/results/summary"
    writers.recover_replace(spark, summary_path, ["run_id"])
    mat_run(results.summarize(checks.filter(F.col("run_id") == run_id)).select(*results.SUMMARY_COLUMNS), "results/summary")
    summary = spark.read.schema(results.SUMMARY_SCHEMA).parquet(summary_path)
    row_counts = {k: v if isinstance(v, int) else v.get.get("rows") for k, v in counts.items()}
    runs.write_run(runs.manifest_rows(spark, run_id, run_ts, row_counts), f"{out}/results/manifest", run_id)
    if catalog:
        register_layers(spark, out, catalog)
    return {"bronze": bronze, "silver": silver, "gold": gold, "checks": checks,
            "summary": summary, "run_summary": summary.filter(F.col("run_id") == run_id),
            "row_counts": row_counts}


def dedup_summary_table(spark: SparkSession, summary_path: str,
                        keys: tuple = ("run_id", "table_name")) -> DataFrame:
    """Maintenance: keep one summary row per (run, table) and rewrite the stored summary
    from itself (staged: the new content is written whole before the old files go, and an interrupted
    replacement is finished first)."""
    writers.recover_replace(spark, summary_path, ["run_id"])
    current = spark.read.schema(results.SUMMARY_SCHEMA).parquet(summary_path)
    writers.staged_replace(results.dedup_summary(current, keys), summary_path, ["run_id"])
    return spark.read.schema(results.SUMMARY_SCHEMA).parquet(summary_path)
