"""Dimensions: type-2 slowly changing dimension as pure functions, and the date dimension.

``scd2_apply(dim, incoming, as_of)`` returns the *whole next version* of the dimension as
one lazy plan over the old version: rows of changed keys are closed, new versions are
appended with fresh surrogate keys.  No UPDATE, no driver-side key list, no global
single-task window: changed keys are a join, surrogate keys come from ``number_rows``
offset by ``max(sk)`` (a scalar subquery).

Reference semantics kept on purpose: the change test is ``src.c <> cur.c`` OR-ed over the
tracked columns, so changes to or from NULL are missed (``null_safe=True`` sees them), and
keys absent from the incoming set are never closed (no delete detection).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecheck.functions.dates import date_key, weekday_name
from lakecheck.functions.predicates import any_changed
from lakecheck.operators.numbering import number_rows
from lakecheck.sinks import keyed

SK, EFF, END, CUR = "sk", "effective_date", "end_date", "is_current"


def _date(d) -> F.Column:
    if isinstance(d, F.Column):
        return d.cast("date")
    if isinstance(d, (_dt.date, _dt.datetime)):
        return F.lit(d.isoformat()[:10]).cast("date")
    return F.lit(str(d)).cast("date")


def scd2_init(src: DataFrame, key: str, initial_date="2025-01-01", sk_col: str = SK,
              buckets: int | None = None) -> DataFrame:
    """First load: every row current, dense surrogate keys 1..n in key order."""
    out = number_rows(src, [key], sk_col, 0, buckets)
    return (out.withColumn(EFF, _date(initial_date))
               .withColumn(END, F.lit(None).cast(T.DateType()))
               .withColumn(CUR, F.lit(True)))


def current(dim: DataFrame) -> DataFrame:
    """Current versions only (the flag filter is pushed into the Parquet scan)."""
    return dim.filter(F.col(CUR))


def version_counts(dim: DataFrame) -> DataFrame:
    """(current_rows, total_rows) in one pass."""
    return dim.agg(F.count_if(F.col(CUR)).alias("current_rows"),
                   F.count(F.lit(1)).alias("total_rows"))


def scd2_changes(incoming: DataFrame, cur: DataFrame, key: str, tracked: Sequence[str],
                 null_safe: bool = False) -> DataFrame:
    """Incoming rows that are new keys or differ from the current version in a tracked column."""
    c = cur.select(F.col(key), F.lit(True).alias("__lc_hit"),
                   *[F.col(t).alias(f"__lc_cur_{t}") for t in tracked])
    j = incoming.join(c, key, "left")
    changed = any_changed([(F.col(t), F.col(f"__lc_cur_{t}")) for t in tracked], null_safe)
    return j.filter(F.col("__lc_hit").isNull() | changed).select(*incoming.columns)


def _new_versions(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], as_of, sk_col: str,
                  null_safe: bool, buckets: int | None) -> DataFrame:
    """The versions a load opens, numbered on from the dimension's highest surrogate key.  ``number_rows`` checkpoints
    them: the change join runs once and also yields the keys to close."""
    changes = scd2_changes(incoming, current(dim), key, tracked, null_safe)
    max_sk = dim.select(F.coalesce(F.max(sk_col), F.lit(0)).cast("bigint")).scalar()
    return (number_rows(changes, [key], sk_col, max_sk, buckets)
            .withColumn(EFF, _date(as_of))
            .withColumn(END, F.lit(None).cast(T.DateType()))
            .withColumn(CUR, F.lit(True)))


def _closed(dim: DataFrame, new: DataFrame, key: str, as_of) -> DataFrame:
    """``dim`` with the current versions of the keys of ``new`` closed."""
    changed_keys = new.select(key).distinct().withColumn("__lc_chg", F.lit(True))
    closing = F.col(CUR) & F.col("__lc_chg").isNotNull()
    return (dim.join(changed_keys, key, "left")
               .withColumn(END, F.when(closing, _date(as_of)).otherwise(F.col(END)))
               .withColumn(CUR, F.when(closing, F.lit(False)).otherwise(F.col(CUR)))
               .select(*dim.columns))


def scd2_apply(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], as_of,
               sk_col: str = SK, null_safe: bool = False, buckets: int | None = None) -> DataFrame:
    """Next version of the dimension after loading ``incoming`` on date ``as_of``."""
    new = _new_versions(dim, incoming, key, tracked, as_of, sk_col, null_safe, buckets)
    return _closed(dim, new, key, as_of).unionByName(new.select(*dim.columns))


def scd2_update(spark: SparkSession, path: str, incoming: DataFrame, key: str, tracked: Sequence[str], as_of,
                sk_col: str = SK, null_safe: bool = False, buckets: int | None = None) -> list[int]:
    """``scd2_apply`` on a dimension stored by ``keyed.write``: only the buckets that hold a changed or new key are
    read whole and rewritten; the others' files stay as they are.  The buckets rewritten.

    A load that died can be run again: buckets it had replaced show no changes, the rest get theirs, with surrogate
    keys that follow those already given."""
    dim = keyed.open_(spark, path)
    parts = keyed.buckets_of(spark, path)
    plain = dim.drop(keyed.BUCKET)
    new = _new_versions(plain, incoming, key, tracked, as_of, sk_col, null_safe, buckets).select(*plain.columns).withColumn(
        keyed.BUCKET, keyed.bucket_of(F.col(key), parts))
    return keyed.update(spark, path, new.select(keyed.BUCKET),
                        lambda rows: _closed(rows, new, key, as_of).unionByName(new.select(*rows.columns)))


def date_dim(df: DataFrame, date_col: str) -> DataFrame:
    """One row per distinct date: date_id (yyyyMMdd int), date, year, month, quarter, weekday."""
    d = F.col("date")
    return (df.select(F.col(date_col).cast("date").alias("date")).distinct()
              .select(date_key(d).alias("date_id"), d,
                      F.year(d).alias("year"), F.month(d).alias("month"),
                      F.quarter(d).alias("quarter"), weekday_name(d).alias("day_of_week")))
