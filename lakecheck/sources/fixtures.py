"""Deterministic dirty inputs derived from the given tables (the stand-ins of FIXTURES.md).

Mapping: encounter = order, patient = customer, doctor = supplier, department = region.
Faults are injected by key arithmetic so every engine derives the same rows: duplicate
patients under new ids, orphan patient ids, NULL and negative amounts, exact and
conflicting duplicate encounters, and a second dimension load with changes, changes to
NULL, a missing key and new keys.  Everything grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecheck.operators.quality import clean_entity, clean_fact
from lakecheck.sources.tables import load

# fixed values: fault-injection moduli, id offsets and dates of FIXTURES.md
DUP_DOCTOR_MOD, DUP_DOCTOR_REM = 7, 3
DUP_PATIENT_MOD, DUP_PATIENT_REM, DUP_PATIENT_OFFSET = 101, 5, 2000000000
ORPHAN_MOD, ORPHAN_REM, ORPHAN_OFFSET = 701, 13, 1000000000
NULL_AMOUNT_MOD, NULL_AMOUNT_REM = 499, 7
NEG_AMOUNT_MOD, NEG_AMOUNT_REM = 1009, 11
EXACT_DUP_MOD, EXACT_DUP_REM = 997, 3
CONFLICT_DUP_MOD, CONFLICT_DUP_REM = 1499, 17
TO_NULL_MOD, TO_NULL_REM = 307, 6
CHANGED_MOD, CHANGED_REM, CHANGED_VALUE = 53, 2, "CHANGED"
MISSING_MOD, MISSING_REM = 401, 9
NEW_KEY_MOD, NEW_KEY_REM, NEW_KEY_OFFSET = 211, 4, 3000000000
FIRST_LOAD, SECOND_LOAD = "2025-01-01", "2025-06-01"
RUN1_ID, RUN1_TS = "20250101_000000", "2025-01-01 00:00:00"
RUN2_ID, RUN2_TS = "20250601_000000", "2025-06-01 00:00:00"

HISTORY_RUNS = ("20250101_000000", "20250601_000000", "20250901_000000", "20251201_000000")
BAD_AMOUNT_MOD, BAD_AMOUNT_REM = 503, 1          # an amount that is no number
BAD_DATE_MOD, BAD_DATE_REM = 607, 2              # a date that is none
CUT_LINE_MOD, CUT_LINE_REM = 809, 3              # a line without its last two fields

ENCOUNTER_COLUMNS = ["encounter_id", "patient_id", "doctor_id", "dept_id", "encounter_date",
                     "billing_amount", "length_of_stay", "diagnosis_code"]
PATIENT_COLUMNS = ["patient_id", "name", "nation_id", "segment"]
PATIENT_ATTRS = ["name", "nation_id", "segment"]
DOCTOR_COLUMNS = ["doctor_id", "name", "dept_id"]
DEPARTMENT_COLUMNS = ["dept_id", "dept_name"]


def _is(c, mod: int, rem: int):
    return (F.col(c) % mod) == rem


def _copies(df: DataFrame, *kinds) -> DataFrame:
    """One scan, several copies: each row is emitted once per kind whose condition holds
    (``kinds`` = (tag, condition) pairs; tag 0 is usually the row itself).  The copy tag is
    in ``__lc_copy``.  Same rows as a UNION ALL of filtered copies, without re-reading the
    table per copy."""
    tags = F.array(*[F.when(cond, F.lit(tag)) for tag, cond in kinds])
    return df.withColumn("__lc_copy", F.explode(tags)).where(F.col("__lc_copy").isNotNull())


def src_department(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "region").select(F.col("r_regionkey").alias("dept_id"),
                                            F.col("r_name").alias("dept_name"))


def src_doctor(spark: SparkSession, sf: str) -> DataFrame:
    s = load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("doctor_id"), F.col("s_name").alias("name"),
        (F.col("s_suppkey") % 5).cast("int").alias("dept_id"))
    return _copies(s, (0, F.lit(True)), (1, _is("doctor_id", DUP_DOCTOR_MOD, DUP_DOCTOR_REM))).drop("__lc_copy")


def src_patient(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_id"), F.col("c_mktsegment").alias("segment"))
    e = _copies(c, (0, F.lit(True)), (1, _is("patient_id", DUP_PATIENT_MOD, DUP_PATIENT_REM)))
    moved = F.col("patient_id") + F.when(F.col("__lc_copy") == 1, F.lit(DUP_PATIENT_OFFSET)).otherwise(F.lit(0))
    return e.withColumn("patient_id", moved).drop("__lc_copy")  # same person under a new id


def base_encounter(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return load(spark, sf, "orders").select(
        k.alias("encounter_id"),
        F.when(k % ORPHAN_MOD == ORPHAN_REM, F.col("o_custkey") + ORPHAN_OFFSET)
         .otherwise(F.col("o_custkey")).alias("patient_id"),
        (k % 10).alias("doctor_id"),
        (k % 5).cast("int").alias("dept_id"),
        F.col("o_orderdate").cast("date").alias("encounter_date"),
        F.when(k % NULL_AMOUNT_MOD == NULL_AMOUNT_REM, F.lit(None).cast("double"))
         .when(k % NEG_AMOUNT_MOD == NEG_AMOUNT_REM, -F.col("o_totalprice"))
         .otherwise(F.col("o_totalprice")).alias("billing_amount"),
        (k % 16).cast("int").alias("length_of_stay"),
        F.col("o_orderpriority").alias("diagnosis_code"))


def src_encounter(spark: SparkSession, sf: str) -> DataFrame:
    # the row, an exact duplicate, and a conflicting duplicate whose amount is NULL
    e = _copies(base_encounter(spark, sf), (0, F.lit(True)),
                (1, _is("encounter_id", EXACT_DUP_MOD, EXACT_DUP_REM)),
                (2, _is("encounter_id", CONFLICT_DUP_MOD, CONFLICT_DUP_REM)))
    amount = F.when(F.col("__lc_copy") == 2, F.lit(None).cast("double")).otherwise(F.col("billing_amount"))
    return e.withColumn("billing_amount", amount).drop("__lc_copy")


def clean_patient(spark: SparkSession, sf: str) -> DataFrame:
    return clean_entity(src_patient(spark, sf), "patient_id", PATIENT_ATTRS, PATIENT_COLUMNS)


def clean_encounter(spark: SparkSession, sf: str) -> DataFrame:
    return clean_fact(src_encounter(spark, sf), "encounter_id", clean_patient(spark, sf),
                      "patient_id", "billing_amount", ENCOUNTER_COLUMNS)


def incoming_patient(spark: SparkSession, sf: str, clean: DataFrame | None = None) -> DataFrame:
    """Second dimension load: some segments changed, some set to NULL, one key in ~400
    missing (must stay current), new keys added."""
    cp = clean if clean is not None else clean_patient(spark, sf)
    pid = F.col("patient_id")
    # copy 0: the existing key (unless missing), with its changes; copy 1: a new key
    e = _copies(cp, (0, pid % MISSING_MOD != MISSING_REM), (1, pid % NEW_KEY_MOD == NEW_KEY_REM))
    kept = F.col("__lc_copy") == 0
    segment = (F.when(kept & (pid % TO_NULL_MOD == TO_NULL_REM), F.lit(None).cast("string"))
                .when(kept & (pid % CHANGED_MOD == CHANGED_REM), F.lit(CHANGED_VALUE))
                .otherwise(F.col("segment")))
    new_id = F.when(kept, pid).otherwise(pid + NEW_KEY_OFFSET)
    return e.select(new_id.alias("patient_id"), "name", "nation_id", segment.alias("segment"))


def damaged_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The encounters as CSV lines, some with values that are no number or date, some cut short."""
    k = F.col("encounter_id")
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ENCOUNTER_COLUMNS}
    text["billing_amount"] = F.when(_is("encounter_id", BAD_AMOUNT_MOD, BAD_AMOUNT_REM), F.lit("n/a")).otherwise(
        F.coalesce(F.col("billing_amount").cast("decimal(38,2)").cast("string"), F.lit("")))
    text["encounter_date"] = F.when(_is("encounter_id", BAD_DATE_MOD, BAD_DATE_REM), F.lit("2025-13-45")).otherwise(text["encounter_date"])
    cut = (k % CUT_LINE_MOD) == CUT_LINE_REM
    whole = F.concat_ws(",", *[text[c] for c in ENCOUNTER_COLUMNS])
    short = F.concat_ws(",", *[text[c] for c in ENCOUNTER_COLUMNS[:-2]])
    return src_encounter(spark, sf).select(F.when(cut, short).otherwise(whole).alias("value"))
