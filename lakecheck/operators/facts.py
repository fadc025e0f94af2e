"""Fact build with surrogate-key lookup, and run snapshots for the fact history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecheck.functions.dates import date_key
from lakecheck.operators.dims import CUR, SK


def build_fact(enc: DataFrame, dim: DataFrame, key: str, date_col: str, columns: Sequence[str],
               sk_col: str = SK, date_key_col: str = "date_id") -> DataFrame:
    """``enc LEFT JOIN current(dim)`` on the natural key for the surrogate key, plus the
    integer date key.  Spark (or AQE, from runtime sizes) broadcasts the key map only when
    it is measured under the broadcast threshold; a large dimension stays a sort-merge
    join whose hot fact keys AQE splits (left side of a left outer join)."""
    sk_map = dim.filter(F.col(CUR)).select(key, sk_col)
    out = enc.withColumn(date_key_col, date_key(F.col(date_col))).join(sk_map, key, "left")
    return out.select(*columns)


def snapshot(fact: DataFrame, run_ts, run_id: str, ts_col: str = "gold_run_ts",
             id_col: str = "gold_run_id") -> DataFrame:
    """Tag a fact with its run timestamp (timestamp_ntz) and run id."""
    ts = run_ts if isinstance(run_ts, F.Column) else F.lit(str(run_ts)).cast("timestamp_ntz")
    return fact.withColumn(ts_col, ts).withColumn(id_col, F.lit(run_id))
