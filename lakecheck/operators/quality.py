"""Cleaning operators: keep-first dedup, entity/fact cleaning, referential filter, issue profile.

Scale notes
-----------
* ``dedup`` is ``row_number() OVER (PARTITION BY keys ORDER BY ...) = 1``.  Spark plans it
  with a *partial* ``WindowGroupLimit`` before the shuffle and a final one after it, so a
  key that holds a third of all rows ships at most one row per map task: the hot group is
  pre-reduced before the exchange, never collected whole.
* ``fk_filter`` is a ``left_semi`` join: it never multiplies rows, and Spark (or AQE at
  runtime) broadcasts the id side only when its measured size is under the broadcast
  threshold; otherwise it is a sort-merge semi join, whose skewed partitions AQE splits.
* ``profile`` is one aggregate pass (plus the semi lookup) - no per-issue scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecheck.functions.predicates import positive_not_null

_RN = "__lc_rn"


def _order_cols(order: Sequence[Column | str] | None, df: DataFrame, keys: Sequence[str]) -> list[Column]:
    if order is None:
        # tie-break on every other column: a total order up to identical rows
        return [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (default: all other columns ascending,
    NULLs last).  Deterministic, unlike ``dropDuplicates`` which keeps an arbitrary row.
    NULL key values group together."""
    keys = list(keys)
    order_cols = _order_cols(order, df, keys)
    if not order_cols:  # every column is a key: plain distinct
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def clean_small_dim(df: DataFrame, key: str, columns: Sequence[str],
                    order: Sequence[Column | str] | None = None) -> DataFrame:
    """Department / doctor cleaning: keep-first by key, then project."""
    return dedup(df.select(*columns), [key], order)


def clean_entity(df: DataFrame, key: str, attrs: Sequence[str], columns: Sequence[str] | None = None,
                 casts: dict[str, str] | None = None) -> DataFrame:
    """Two-stage entity dedup: first by id, then by the attribute tuple (the same person
    under a new id), keeping the smallest id.  ``casts`` are applied between the stages."""
    columns = list(columns or df.columns)
    by_id = dedup(df, [key])
    for c, t in (casts or {}).items():  # try_cast: a malformed raw value becomes NULL, never fails the run
        by_id = by_id.withColumn(c, F.col(c).try_cast(t))
    by_attrs = dedup(by_id, list(attrs), [F.col(key).asc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in by_id.columns if c != key and c not in attrs])
    return by_attrs.select(*columns)


def fk_filter(df: DataFrame, parent: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``fk`` exists in ``parent`` (semi join: never multiplies rows)."""
    pk = pk or fk
    ids = parent.select(F.col(pk).alias(fk))
    return df.join(ids, fk, "left_semi")


def clean_fact(df: DataFrame, key: str, parent: DataFrame, fk: str, amount: str,
               columns: Sequence[str], parent_key: str | None = None,
               order: Sequence[Column | str] | None = None,
               casts: dict[str, str] | None = None) -> DataFrame:
    """dedup by key -> casts (``try_cast``) -> validity (amount and fk not null, amount > 0) ->
    referential filter -> projection, in the reference's order (dedup before validity).  The default
    tie-break puts the copies that pass the validity test first, so a valid copy of a duplicate wins."""
    if order is None:
        number = F.col(amount).try_cast(casts[amount]) if amount in (casts or {}) else F.col(amount)
        parent_id = F.col(fk).try_cast(casts[fk]) if fk in (casts or {}) else F.col(fk)
        valid = F.coalesce((number > 0) & parent_id.isNotNull(), F.lit(False))
        order = [valid.desc(), F.col(amount).asc_nulls_last()] + [
            F.col(c).asc_nulls_last() for c in df.columns if c not in (key, amount)]
    out = dedup(df, [key], order)
    for c, t in (casts or {}).items():  # try_cast: a malformed amount becomes NULL and fails validity
        out = out.withColumn(c, F.col(c).try_cast(t))
    out = out.filter(positive_not_null(amount) & F.col(fk).isNotNull())
    out = fk_filter(out, parent, fk, parent_key)
    return out.select(*columns)


def try_casts(df: DataFrame, casts: dict[str, str], reject_col: str = "_bad_casts") -> DataFrame:
    """Cast raw text with ``try_cast`` (ANSI mode raises on a bad plain cast) and count, per
    row, values that were non-null before and null after."""
    bad = F.lit(0)
    for c, t in casts.items():
        casted = F.col(c).try_cast(t)
        bad = bad + F.when(F.col(c).isNotNull() & casted.isNull(), 1).otherwise(0)
    out = df.withColumn(reject_col, bad)
    for c, t in casts.items():
        out = out.withColumn(c, F.col(c).try_cast(t))
    return out


def profile(df: DataFrame, key: str, amount: str, fk: str, parent: DataFrame,
            parent_key: str | None = None) -> DataFrame:
    """Issue counts of a raw fact in one pass: surplus rows per key (count - distinct keys),
    NULL amounts, non-positive amounts and orphan foreign keys.  Returns (issue, n)."""
    parent_key = parent_key or fk
    hits = parent.select(F.col(parent_key).alias(fk)).distinct().withColumn("__lc_hit", F.lit(True))
    j = df.select(key, amount, fk).join(hits, fk, "left")
    m = j.agg(
        (F.count(F.lit(1)) - F.count_distinct(F.col(key))).alias("duplicate_rows"),
        F.count_if(F.col(amount).isNull()).alias("null_amount"),
        F.count_if(F.col(amount) <= 0).alias("non_positive_amount"),
        F.count_if(F.col(fk).isNotNull() & F.col("__lc_hit").isNull()).alias("orphan_fk"),
    )
    issues = ["duplicate_rows", "null_amount", "non_positive_amount", "orphan_fk"]
    return m.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("issue"), F.col(i).cast("bigint").alias("n")) for i in issues])))
