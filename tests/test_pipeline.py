"""End-to-end runs: CSV ingest with lineage, layers, history, idempotent summary."""

from pyspark.sql import functions as F

from lakecheck.plans import pipeline
from lakecheck.plans import queries as Q
from lakecheck.session import scratch_path
from lakecheck.sinks import writers
from lakecheck.sources.csv import ingest

from conftest import SF_SMALL


def test_two_runs_end_to_end(spark):
    raw = Q.stage_raw_files(spark, SF_SMALL)
    lake = scratch_path(spark, "lake")
    r1 = pipeline.run(spark, raw, lake, "20250101_000000", "2025-01-01 00:00:00")
    s1 = r1["run_summary"].collect()
    assert len(s1) == 1 and s1[0].total_checks == 5 and s1[0].overall_status == "FAIL"
    assert s1[0].total_mismatches == 11 + 1 + 1 + 1 + 9
    assert r1["gold"]["fact"].count() == 1492
    assert r1["gold"]["fact"].filter(F.col("patient_sk").isNull()).count() == 0
    assert r1["bronze"]["encounters"].select("_source_file").distinct().first()[0] == "encounters.csv"

    # second run: SCD2 update from the first run's dimension; same inputs -> no new versions
    assert r1["row_counts"]["silver/encounters"] == 1492
    assert r1["row_counts"]["bronze/encounters"] == 1503
    prev = spark.read.parquet(f"{lake}/gold/dim_patient")  # the run replaces these very files
    r2 = pipeline.run(spark, raw, lake, "20250601_000000", "2025-06-01 00:00:00", previous_dim=prev)
    assert r2["gold"]["dim_patient"].count() == 150
    assert r2["summary"].count() == 2
    hist = writers.read_runs(spark, f"{lake}/gold/fact_history", run_col="gold_run_id")
    assert sorted(r[0] for r in hist.groupBy("gold_run_id").count().select("gold_run_id").collect()) == [
        "20250101_000000", "20250601_000000"]

    # re-running a run id replaces its partitions and does not duplicate the summary
    prev = spark.read.parquet(f"{lake}/gold/dim_patient")
    r3 = pipeline.run(spark, raw, lake, "20250601_000000", "2025-06-01 00:00:00", previous_dim=prev)
    assert r3["summary"].count() == 2
    assert r3["checks"].count() == 10


def test_ingest_lineage_and_inference(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "id int, s string, v double")
    writers.export_csv(df, f"{tmp_dir}/x.csv")
    out = ingest(spark, tmp_dir, {"x": "x.csv"}, infer=True, ingestion_ts="2025-01-01 00:00:00")["x"]
    assert dict(out.dtypes)["id"] == "int" and dict(out.dtypes)["v"] == "double"
    assert {r._source_file for r in out.collect()} == {"x.csv"}
    assert out.select("_ingestion_ts").distinct().count() == 1


def test_staged_replace_self_overwrite(spark, tmp_dir):
    spark.range(10).withColumn("g", F.col("id") % 2).write.parquet(tmp_dir)
    cur = spark.read.parquet(tmp_dir)
    writers.staged_replace(cur.dropDuplicates(["g"]), tmp_dir)
    assert spark.read.parquet(tmp_dir).count() == 2


def test_observed_write_count(spark, tmp_dir):
    df, obs = writers.observed(spark.range(123))
    df.write.parquet(tmp_dir)
    assert obs.get["rows"] == 123


def test_write_runs_replaces_only_that_run(spark, tmp_dir):
    mk = lambda run, n: spark.range(n).withColumn("run_id", F.lit(run))
    writers.write_runs(mk("r1", 3), tmp_dir)
    writers.write_runs(mk("r2", 4), tmp_dir)
    writers.write_runs(mk("r1", 5), tmp_dir)
    got = {r.run_id: r["count"] for r in writers.read_runs(spark, tmp_dir).groupBy("run_id").count().collect()}
    assert got == {"r1": 5, "r2": 4}


def test_catalog_sinks(spark):
    writers.ensure_database(spark, "lc_results")
    name = "lc_results.summary_t"
    assert not spark.catalog.tableExists(name)
    writers.save_table(spark.range(3).withColumn("run_id", F.lit("r1")), name)
    writers.save_table(spark.range(2).withColumn("run_id", F.lit("r2")), name, mode="append")
    assert spark.catalog.tableExists(name)
    assert spark.table(name).count() == 5
    # an overwrite replaces the schema as well
    writers.save_table(spark.range(1).withColumn("x", F.lit(1.5)), name)
    assert spark.table(name).columns == ["id", "x"]


def test_summary_maintenance_dedup(spark, tmp_dir):
    from lakecheck.operators import results
    rows = [("r1", "2025-01-01 00:00:00", "t1", 5, 5, 0, 0, "PASS"),
            ("r1", "2025-01-01 00:00:00", "t2", 5, 4, 1, 3, "FAIL")]
    s = spark.createDataFrame(rows, "run_id string, run_ts string, table_name string, total_checks bigint, "
                                    "passed bigint, failed bigint, total_mismatches bigint, overall_status string")
    s = s.withColumn("run_ts", F.col("run_ts").cast("timestamp_ntz")).select(*results.SUMMARY_COLUMNS)
    writers.append(s, tmp_dir, ["run_id"])
    writers.append(s, tmp_dir, ["run_id"])  # the same run summarized twice
    out = pipeline.dedup_summary_table(spark, tmp_dir)
    assert sorted((r.run_id, r.table_name) for r in out.collect()) == [("r1", "t1"), ("r1", "t2")]


def test_catalog_registration_and_report_sql(spark):
    from lakecheck.operators import results
    raw = Q.stage_raw_files(spark, SF_SMALL)
    lake = scratch_path(spark, "lake")
    cat = {"bronze": "lc_bronze", "silver": "lc_silver", "gold": "lc_gold", "results": "lc_results_r"}
    pipeline.run(spark, raw, lake, "20250101_000000", "2025-01-01 00:00:00", catalog=cat)
    prev = spark.read.parquet(f"{lake}/gold/dim_patient")
    pipeline.run(spark, raw, lake, "20250601_000000", "2025-06-01 00:00:00", previous_dim=prev, catalog=cat)
    assert spark.table("lc_bronze.raw_encounters").count() == 1503
    assert spark.table("lc_gold.fact").count() == 1492
    assert spark.table("lc_gold.fact_history").select("gold_run_id").distinct().count() == 2
    db = "lc_results_r"
    assert [r.run_id for r in results.report(spark, db, "runs").collect()] == ["20250601_000000",
                                                                                "20250101_000000"]
    one = results.report(spark, db, "run_summary", "20250601_000000").collect()
    assert len(one) == 1 and one[0].total_checks == 5
    api = sorted(map(tuple, results.run_checks_view(spark.table(f"{db}.checks"), "20250601_000000").collect()))
    assert sorted(map(tuple, results.report(spark, db, "checks", "20250601_000000").collect())) == api
    assert results.report(spark, db, "diffs", "20250601_000000", n=5).count() == 5
    assert results.report(spark, db, "trend").count() == 2


def test_size_for_input_scales_partitions_with_the_input(spark):
    from lakecheck.session import SHUFFLE_PARTITION_BYTES, input_bytes, size_for_input
    paths = [f"{SF_SMALL}/orders.parquet", f"{SF_SMALL}/lineitem.parquet"]
    n = input_bytes(spark, paths)
    assert n > 0
    conf = size_for_input(spark, paths, apply=False)
    assert int(conf["spark.sql.shuffle.partitions"]) == spark.sparkContext.defaultParallelism
    big = size_for_input(spark, paths, expansion=10 * SHUFFLE_PARTITION_BYTES / n, apply=False)
    assert int(big["spark.sql.shuffle.partitions"]) >= 10


def test_command_line_run(spark, capsys):
    from lakecheck.__main__ import main
    raw = Q.stage_raw_files(spark, SF_SMALL)
    lake = scratch_path(spark, "lake")
    main(["--raw", raw, "--out", lake, "--run-ts", "2025-01-01 00:00:00"])
    main(["--raw", raw, "--out", lake, "--run-ts", "2025-06-01 00:00:00", "--update"])
    printed = capsys.readouterr().out
    assert "20250101_000000" in printed and "20250601_000000" in printed
    s = spark.read.parquet(f"{lake}/results/summary")
    assert sorted(r.run_id for r in s.collect()) == ["20250101_000000", "20250601_000000"]


def test_path_exists(spark, tmp_dir):
    assert not writers.path_exists(spark, f"{tmp_dir}/none")
    spark.range(3).write.parquet(f"{tmp_dir}/some")
    assert writers.path_exists(spark, f"{tmp_dir}/some")


def test_default_runs_keep_the_dimension_history(spark):
    """A second run without any argument applies to the dimension it finds; a reset must be asked for."""
    raw, lake = Q.stage_raw_files(spark, SF_SMALL), scratch_path(spark, "lake")
    pipeline.run(spark, raw, lake, "20250101_000000", "2025-01-01 00:00:00")
    path = f"{lake}/gold/dim_patient"
    changed = spark.read.parquet(path).withColumn(
        "segment", F.when(F.col("patient_sk") == 1, F.lit("OTHER")).otherwise(F.col("segment")))
    writers.staged_replace(changed, path)
    again = pipeline.run(spark, raw, lake, "20250601_000000", "2025-06-01 00:00:00")["gold"]["dim_patient"]
    assert again.count() == 151 and again.filter("not is_current").count() == 1
    reset = pipeline.run(spark, raw, lake, "20250701_000000", "2025-07-01 00:00:00", reset_dim=True)
    assert reset["gold"]["dim_patient"].count() == 150
    # an older run id still gets its own summary
    late = pipeline.run(spark, raw, lake, "20240101_000000", "2024-01-01 00:00:00")
    assert late["run_summary"].count() == 1 and late["summary"].count() == 4
    # every difference is stored
    details = writers.read_runs(spark, f"{lake}/results/diff_details").filter("run_id = '20250101_000000'")
    assert details.agg(F.sum("n_rows")).first()[0] == 9


def test_run_ids_stay_text(spark, tmp_dir):
    writers.write_runs(spark.createDataFrame([("0007", 1)], "run_id string, v int"), tmp_dir)
    assert [r.run_id for r in writers.read_runs(spark, tmp_dir).collect()] == ["0007"]


# ---------------------------------------------------------------- re-runs, clean runs, the manifest, other files

PEOPLE = "patient_id,name,nation_id,segment\n1,ann,1,A\n2,bob,2,B\n"
VISITS = "encounter_id,patient_id,doctor_id,dept_id,encounter_date,billing_amount,length_of_stay,diagnosis_code\n"


def put_files(base, **text):
    import os
    os.makedirs(base.removeprefix("file:"), exist_ok=True)
    small = {"departments": "dept_id,dept_name\n0,d\n", "doctors": "doctor_id,name,dept_id\n7,doc,0\n", "patients": PEOPLE}
    for name, t in {**small, **text}.items():
        with open(f"{base.removeprefix('file:')}/{name}.csv", "w") as f:
            f.write(t)


def test_clean_run_and_rerun_with_catalog(spark, tmp_dir):
    raw, lake = f"{tmp_dir}/raw", f"{tmp_dir}/lake"
    cat = {"gold": "lc_gold_clean", "results": "lc_results_clean"}
    put_files(raw, encounters=VISITS + "1,1,7,0,2025-01-02,10.5,1,X\n2,2,7,0,2025-01-03,20,2,Y\n")
    one = pipeline.run(spark, raw, lake, "r1", "2025-01-01 00:00:00", catalog=cat)
    assert one["run_summary"].first().overall_status == "PASS"
    details = spark.table("lc_results_clean.diff_details")
    assert details.count() == 0 and "src_billing_amount" in details.columns
    # the same run with a bad row, then clean again: its differences come and go
    put_files(raw, encounters=VISITS + "1,1,7,0,2025-01-02,10.5,1,X\n2,2,7,0,2025-01-03,-20,2,Y\n")
    pipeline.run(spark, raw, lake, "r1", "2025-01-01 00:00:00", catalog=cat)
    assert spark.table("lc_results_clean.diff_details").count() == 1
    put_files(raw, encounters=VISITS + "1,1,7,0,2025-01-02,10.5,1,X\n2,2,7,0,2025-01-03,20,2,Y\n")
    again = pipeline.run(spark, raw, lake, "r1", "2025-01-01 00:00:00", catalog=cat)
    assert again["run_summary"].first().overall_status == "PASS"
    assert spark.table("lc_results_clean.diff_details").count() == 0
    assert spark.table("lc_gold_clean.dim_patient").count() == 2


def test_manifest_has_the_rows_of_every_dataset(spark, tmp_dir):
    raw, lake = f"{tmp_dir}/raw", f"{tmp_dir}/lake"
    put_files(raw, encounters=VISITS + "1,1,7,0,2025-01-02,10.5,1,X\n2,9,7,0,2025-01-03,20,2,Y\n3,2,7,0,2025-01-03,,2,Y\n")
    out = pipeline.run(spark, raw, lake, "r1", "2025-01-01 00:00:00")
    m = {r["dataset"]: r["n_rows"] for r in writers.read_runs(spark, f"{lake}/results/manifest").collect()}
    assert m == out["row_counts"]
    assert {d: m[d] for d in ("bronze/encounters", "silver/encounters", "gold/fact", "gold/dim_patient", "results/summary", "results/rejects")} == {
        "bronze/encounters": 3, "silver/encounters": 1, "gold/fact": 1, "gold/dim_patient": 2, "results/summary": 1, "results/rejects": 0}
    assert m["results/checks"] == 5 and m["gold/fact_history"] == 1 and m["results/diff_details"] == 2


def test_rejects_of_a_run(spark, tmp_dir):
    raw, lake = f"{tmp_dir}/raw", f"{tmp_dir}/lake"
    put_files(raw, encounters=VISITS + "1,1,7,0,2025-01-02,abc,1,X\n2,2,7,0,not a date,20,2,Y\n3,2,7\n", patients=PEOPLE + "x3,cy,1,A\n")
    pipeline.run(spark, raw, lake, "r1", "2025-01-01 00:00:00")
    got = writers.read_runs(spark, f"{lake}/results/rejects").select("table_name", "source_file", "reason", "column_name", "raw_value")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([
        ("encounters", "encounters.csv", "cast", "billing_amount", "abc"), ("encounters", "encounters.csv", "cast", "encounter_date", "not a date"),
        ("encounters", "encounters.csv", "malformed", None, "3,2,7"), ("patients", "patients.csv", "cast", "patient_id", "x3")], key=str)
    assert spark.read.parquet(f"{lake}/bronze/encounters").count() == 3


def test_update_of_the_stored_dimension_touches_few_files(spark, tmp_dir):
    import os
    raw, lake = f"{tmp_dir}/raw", f"{tmp_dir}/lake"
    people = "patient_id,name,nation_id,segment\n" + "".join(f"{i},n{i},1,A\n" for i in range(300))
    put_files(raw, patients=people, encounters=VISITS + "1,1,7,0,2025-01-02,10.5,1,X\n")
    pipeline.run(spark, raw, lake, "r1", "2025-01-01 00:00:00")
    state = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{lake}/gold/dim_patient".removeprefix("file:"))
                     for f in fs if f.endswith(".parquet")}
    before = state()
    put_files(raw, patients=people.replace("5,n5,1,A", "5,n5,1,B"), encounters=VISITS + "1,1,7,0,2025-01-02,10.5,1,X\n")
    dim = pipeline.run(spark, raw, lake, "r2", "2025-02-01 00:00:00")["gold"]["dim_patient"]
    after = state()
    assert dim.count() == 300 + dim.filter("not is_current").count() and dim.filter("not is_current").count() >= 1
    kept = sum(before[f] == after.get(f) for f in before)
    assert len(before) > 30 and kept >= len(before) - dim.filter("not is_current").count()


def test_files_of_the_clinic_layout(spark, tmp_dir):
    raw, lake = f"{tmp_dir}/raw", f"{tmp_dir}/lake"
    put_files(raw, departments="dept_id,dept_name,building\n1,Heart,A\n", doctors="doctor_id,name,specialization,dept_id\n10,Doc,Surgeon,1\n",
              patients="patient_id,name,age,gender,blood_group,city\n1,Ann,30,F,A+,X\n2,Bob,41,M,B+,Y\n3,Ann,30,F,A+,X\n4,Cy,old,M,O+,Z\n",
              encounters=VISITS + "100,1,10,1,2025-01-02,99.5,3,D1\n101,2,10,1,2025-02-03,10.25,0,D2\n102,77,10,1,2025-02-03,5,1,D2\n101,2,10,1,2025-02-03,10.25,0,D2\n")
    out = pipeline.run(spark, raw, lake, "r1", "2025-01-01 00:00:00", spec=pipeline.CLINIC_SPEC)
    assert [tuple(r) for r in out["gold"]["dim_patient"].select("patient_id", "name", "age", "gender", "blood_group", "city", "patient_sk").orderBy("patient_id").collect()] == [
        (1, "Ann", 30, "F", "A+", "X", 1), (2, "Bob", 41, "M", "B+", "Y", 2), (4, "Cy", None, "M", "O+", "Z", 3)]
    assert out["gold"]["fact"].columns == pipeline.FACT_COLUMNS and out["gold"]["fact"].count() == 2
    s = out["run_summary"].first()
    assert (s.total_checks, s.overall_status) == (5, "FAIL")
    assert writers.read_runs(spark, f"{lake}/results/rejects").select("column_name", "raw_value").collect()[0][:] == ("age", "old")


def test_interrupted_maintenance_loses_nothing(spark, tmp_dir, monkeypatch):
    df = spark.range(6).withColumn("g", F.col("id") % 2)
    df.write.partitionBy("g").parquet(tmp_dir)

    def die(*_, **__):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(writers, "overwrite", die)
        try:
            writers.staged_replace(spark.read.parquet(tmp_dir).where("id > 1"), tmp_dir, ["g"])
        except RuntimeError:
            pass
    writers.delete_path(spark, tmp_dir)                 # as if it had died after the old files went
    assert writers.recover_replace(spark, tmp_dir, ["g"])
    assert sorted(r[0] for r in spark.read.parquet(tmp_dir).select("id").collect()) == [2, 3, 4, 5]
    assert not writers.recover_replace(spark, tmp_dir, ["g"])
