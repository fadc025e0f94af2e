"""Source-vs-target reconciliation: ROW_COUNT, COLUMN_SUM, COLUMN_HASH (table fingerprint),
RECORD_DIFF, diff details and the check log.

Plan shape (what makes it hold at scale)
----------------------------------------
* **One aggregate for all checks.**  Row counts, exact decimal sums, both fingerprints and
  the diff count come out of a single global aggregate, each task emitting one partial
  row.  No ``collect``; statuses are ``when`` expressions.
* **Exact, order-independent numbers.**  Doubles are summed without any rounding
  (``functions.exact_sum``; the reference's double sums depend on task order), other numbers as
  decimals; the sums are compared by their exact difference; the fingerprint is the sum of the first
  15 hex digits of md5 as ``decimal(38,0)`` - independent of partitioning and sensitive to
  multiplicity.
* **Both sides grouped once, together.**  ``versions`` unions the two sides and groups by
  (key, columns) with a count per side: both tables share its two shuffles, the first of which
  spreads and collapses a hot key's identical copies before the second groups what is left.
* **RECORD_DIFF counted, never enumerated.**  The reference's row-level diff is a full
  outer join on the key, so a key with m source and n target rows stands for m x n pairs.
  The number of differing pairs is ``m*n - sum over equal versions of (s*t)`` per key (plus
  the flagged rows of one-sided and NULL keys): key-level aggregates only, linear work
  whatever the duplication.
* **Diff rows stay linear.**  Versions are paired only for keys where one side has a single
  version (every other version meets that one row: output <= input).  A key with several
  versions on *both* sides (many-to-many) lists each version once, with the other side's
  columns NULL, instead of emitting the cross product; its pair count is still exact in
  the check.  Identical copies are a count (``n_rows``), never repeated rows, except in the
  capped details.
* **Details touch only n keys.**  The first n diff rows in key order come from the first n
  keys with differences: a top-n over the key statistics picks them, and only their
  versions (a map-side semi join) are diffed and expanded (at most n rows).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecheck.functions.exact_sum import exact_sums
from lakecheck.functions.hashing import hash60, row_hash
from lakecheck.functions.predicates import any_differs

AMOUNT = T.DecimalType(18, 2)
AMOUNT_TEXT = T.DecimalType(38, 2)
COUNT = T.DecimalType(38, 0)   # pair counts (m * n) can exceed bigint before the subtraction

# fixed values: check-log vocabulary
ROW_COUNT, COLUMN_SUM, COLUMN_HASH, RECORD_DIFF = "ROW_COUNT", "COLUMN_SUM", "COLUMN_HASH", "RECORD_DIFF"
PASS, FAIL = "PASS", "FAIL"
METRIC_ROW_COUNT = "row_count"
METRIC_SUM_PREFIX = "sum_"
METRIC_FINGERPRINT = "table_fingerprint_md5"
METRIC_MISMATCHED = "mismatched_rows"

CHECK_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_ts", T.TimestampNTZType()),
    T.StructField("check_type", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("source_value", T.StringType()),
    T.StructField("target_value", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("mismatch_count", T.LongType()),
])
CHECK_COLUMNS = [f.name for f in CHECK_SCHEMA.fields]

SN, TN = "__lc_sn", "__lc_tn"   # per-side multiplicity of a version
FROM, AMOUNTS = "__lc_from", "__lc_amounts"   # where a row was read, and a hash of its doubles, while versions are grouped

# fixed values: tasks of the grouping into versions
PARTS_FACTOR = 4           # per shuffle partition of the session
PARTS_MAX = 200            # up to here Spark writes a shuffle without holding its rows (bypassMergeThreshold)


@dataclass(frozen=True)
class CheckSpec:
    """What to compare between a source and a target table."""
    key: str
    sum_cols: Sequence[str]
    hash_cols: Sequence[str]
    compare_cols: Sequence[str]
    table_name: str
    decimal_scale: int | None = 2     # doubles enter row hashes as decimal(38, scale) text
    null_token: str | None = None     # None = reference (NULLs skipped); a token = strict
    tolerance: float = 0.01
    sep: str = "||"


def _ts(run_ts) -> Column:
    return run_ts if isinstance(run_ts, Column) else F.lit(str(run_ts)).cast("timestamp_ntz")


# ---------------------------------------------------------------- row hash / fingerprint

def row_hashes(df: DataFrame, key: str, cols: Sequence[str], decimal_scale: int | None = 2,
               null_token: str | None = None, sep: str = "||") -> DataFrame:
    """(key, row_hash): md5 of the row text over ``cols``."""
    return df.select(F.col(key), row_hash(df, cols, sep, decimal_scale, null_token).alias("row_hash"))


def fingerprint(df: DataFrame, cols: Sequence[str], decimal_scale: int | None = 2,
                null_token: str | None = None, sep: str = "||") -> DataFrame:
    """One row: ``fingerprint`` = sum of 60-bit row-hash prefixes, decimal(38,0); NULL if empty."""
    h = hash60(row_hash(df, cols, sep, decimal_scale, null_token))
    return df.select(h.alias("__lc_h")).agg(F.sum("__lc_h").cast(T.DecimalType(38, 0)).alias("fingerprint"))


# ---------------------------------------------------------------- versions

def check_columns(spec: CheckSpec) -> list[str]:
    out: list[str] = []
    for c in [spec.key, *spec.compare_cols, *spec.hash_cols, *spec.sum_cols]:
        if c not in out:
            out.append(c)
    return out


def _version_parts(df: DataFrame) -> int:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(n, min(n * PARTS_FACTOR, PARTS_MAX))


def versions(src: DataFrame, tgt: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows over ``cols`` of both sides with their multiplicity per side
    (``__lc_sn``, ``__lc_tn``).  One grouping over the union serves both tables.  GROUP BY
    treats NULLs as equal, so two versions are equal exactly when ``s <=> t`` holds for
    every column.

    A side may come with sorts of its own that hold a whole partition in memory, and distinct rows do not
    shrink when they are combined beside them.  So the rows first leave the sides' tasks: they are dealt by
    where they were read and by their columns, and identical copies collapse there, so that a hot row's copies
    spread over many tasks; what is left is dealt by its columns and grouped.  Both use more and smaller tasks
    than the session's shuffles.

    The doubles are dealt by a hash of theirs, which like GROUP BY takes -0.0 for 0.0 and every NaN for one.
    The target's columns are passed through a condition, so that two sides laid out alike (a table against
    itself) are not grouped where they lie."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    moved = [F.when(F.col(c).isNotNull(), F.col(c)).alias(c) for c in cols]
    u = (src.select(*cols, one.alias(SN), zero.alias(TN))
         .unionByName(tgt.select(*moved, zero.alias(SN), one.alias(TN))))
    doubles, by, n = [c for c in cols if _is_double(u, c)], [c for c in cols if not _is_double(u, c)], _version_parts(u)
    if doubles:
        u, by = u.withColumn(AMOUNTS, F.xxhash64(*doubles)), [*by, AMOUNTS]
    near = (u.withColumn(FROM, F.spark_partition_id()).repartition(n, FROM, *by)
            .groupBy(FROM, *by, *doubles).agg(F.sum(SN).alias(SN), F.sum(TN).alias(TN)))
    v = near.repartition(n, *by).groupBy(*by, *doubles).agg(F.sum(SN).alias(SN), F.sum(TN).alias(TN))
    return v.select(*cols, SN, TN)


def narrow_versions(v: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Re-group versions to fewer columns (only when the checks grouped by more)."""
    if set(v.columns) == {*cols, SN, TN}:
        return v
    return v.groupBy(*cols).agg(F.sum(SN).alias(SN), F.sum(TN).alias(TN))


def _any_value(cols: Sequence[str]) -> Column:
    """A one-sided row is flagged unless all its compared columns are NULL (three-valued
    logic of the reference's predicate against the missing side)."""
    return reduce(or_, [F.col(c).isNotNull() for c in cols], F.lit(False))


def key_stats(v: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Per key: number of versions per side (``__lc_ds``, ``__lc_dt``), rows per side,
    equal-version pairs and flagged one-sided rows; and ``__lc_d`` = the number of differing
    row pairs of the reference's key join for that key.  NULL keys never match, so their
    group counts as one-sided on both sides.  Partial aggregation first, so a hot key costs
    one row per map task in the shuffle.  No filter sits between ``v`` and this aggregate:
    every consumer of ``v`` keeps the same plan, and its exchange is reused."""
    sn, tn, anyv = F.col(SN), F.col(TN), _any_value(cols)
    st = v.groupBy(key).agg(
        F.count_if(sn > 0).alias("__lc_ds"), F.count_if(tn > 0).alias("__lc_dt"),
        F.sum(sn).alias("__lc_m"), F.sum(tn).alias("__lc_n"),
        F.sum(sn.cast(COUNT) * tn.cast(COUNT)).alias("__lc_eq"),
        F.sum(F.when(anyv, sn + tn).otherwise(F.lit(0))).alias("__lc_flag"))
    m, n = F.col("__lc_m"), F.col("__lc_n")
    both = F.when(F.col(key).isNotNull() & (m > 0) & (n > 0),
                  m.cast(COUNT) * n.cast(COUNT) - F.col("__lc_eq"))
    return st.withColumn("__lc_d", both.otherwise(F.col("__lc_flag").cast(COUNT)))


def diff_count_rows(v: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One row, ``__lc_d``: the exact row count of the reference's record diff (NULL without rows).  Summed here,
    not beside the versions: in one stage with them, the far smaller shuffle of the key statistics is read by one task."""
    return key_stats(v, key, cols).agg(F.sum("__lc_d").cast(COUNT).alias("__lc_d"))


# ---------------------------------------------------------------- one-pass metrics

def _is_double(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def _amount(df: DataFrame, c: str) -> T.DecimalType:
    """The decimal a column is summed in: its own scale if it has one, else two decimals."""
    kind = df.schema[c].dataType
    return kind if isinstance(kind, T.DecimalType) and kind.scale > AMOUNT.scale else AMOUNT


def _weighted(df: DataFrame, spec: CheckSpec, sn: Column, tn: Column) -> DataFrame:
    """Per row: per-side counts, decimal amounts and 60-bit hashes, weighted by the row's
    multiplicity on each side.  Doubles are summed exactly on their own (``_exact_part``)."""
    cols = [sn.alias("__lc_sc"), tn.alias("__lc_tc")]
    for i, c in enumerate(spec.sum_cols):
        if _is_double(df, c):
            cols += _no_exact(i)
        else:
            v = F.col(c).cast(_amount(df, c))
            cols += [(v * sn).alias(f"__lc_ss{i}"), (v * tn).alias(f"__lc_ts{i}")]
    h = hash60(row_hash(df, spec.hash_cols, spec.sep, spec.decimal_scale, spec.null_token))
    cols += [(h * sn).cast(COUNT).alias("__lc_sh"), (h * tn).cast(COUNT).alias("__lc_th"),
             F.lit(None).cast(COUNT).alias("__lc_d")]
    return df.select(*cols)


def _no_exact(i: int) -> list[Column]:
    return [F.lit(None).cast("double").alias(f"__lc_ss{i}"), F.lit(None).cast("double").alias(f"__lc_ts{i}"),
            F.lit(None).cast("double").alias(f"__lc_xd{i}"), F.lit(None).cast("boolean").alias(f"__lc_xm{i}")]


def _other_part(df: DataFrame, spec: CheckSpec, exact: dict[int, list[Column]], d: Column) -> list[Column]:
    """The columns of ``_weighted`` for a row that only carries exact sums or key differences."""
    cols = [F.lit(None).cast("bigint").alias("__lc_sc"), F.lit(None).cast("bigint").alias("__lc_tc")]
    for i, c in enumerate(spec.sum_cols):
        none = [F.lit(None).cast(AMOUNT_TEXT).alias(f"__lc_{x}s{i}") for x in "st"]
        cols += exact.get(i) or (_no_exact(i) if _is_double(df, c) else none)
    return [*cols, F.lit(None).cast(COUNT).alias("__lc_sh"), F.lit(None).cast(COUNT).alias("__lc_th"), d.alias("__lc_d")]


def _exact_part(df: DataFrame, spec: CheckSpec, sn: Column, tn: Column) -> DataFrame | None:
    """One row per double sum column: its exact sums per side, their exact difference, and whether NaN and infinities
    agree (``functions.exact_sum``)."""
    at = [i for i, c in enumerate(spec.sum_cols) if _is_double(df, c)]
    if not at:
        return None
    sums = exact_sums(df, [F.col(spec.sum_cols[i]) for i in at], sn, tn)
    own = {i: [F.when(F.col("series") == k, F.col(x)).alias(f"__lc_{n}{i}") for n, x in
               (("ss", "left"), ("ts", "right"), ("xd", "difference"), ("xm", "marks_equal"))] for k, i in enumerate(at)}
    return sums.select(*_other_part(df, spec, own, F.lit(None).cast(COUNT)))


def _diff_part(df: DataFrame, d: DataFrame, spec: CheckSpec) -> DataFrame:
    return d.select(*_other_part(df, spec, {}, F.col("__lc_d")))


def _metrics_of(df: DataFrame, u: DataFrame, spec: CheckSpec) -> DataFrame:
    aggs = [F.coalesce(F.sum("__lc_sc"), F.lit(0)).cast("bigint").alias("src_rows"),
            F.coalesce(F.sum("__lc_tc"), F.lit(0)).cast("bigint").alias("tgt_rows")]
    for i, c in enumerate(spec.sum_cols):
        if _is_double(df, c):
            for name, x in (("src_sum", "ss"), ("tgt_sum", "ts"), ("diff_sum", "xd"), ("marks", "xm")):
                aggs.append(F.max(f"__lc_{x}{i}").alias(f"{name}{i}"))        # one row carries them
        else:
            text = T.DecimalType(38, _amount(df, c).scale)
            for name, x in (("src_sum", "ss"), ("tgt_sum", "ts")):
                aggs.append(F.coalesce(F.sum(f"__lc_{x}{i}"), F.lit(0)).cast(text).alias(f"{name}{i}"))
    # a side without rows has no fingerprint (NULL), as the reference's empty-table case
    aggs.append(F.when(F.sum("__lc_sc") > 0, F.sum("__lc_sh")).cast(COUNT).alias("src_fp"))
    aggs.append(F.when(F.sum("__lc_tc") > 0, F.sum("__lc_th")).cast(COUNT).alias("tgt_fp"))
    aggs.append(F.coalesce(F.sum("__lc_d"), F.lit(0)).cast("bigint").alias("n_diff"))
    return u.agg(*aggs)


def metrics(src: DataFrame, tgt: DataFrame, spec: CheckSpec) -> DataFrame:
    """One row with src_rows, tgt_rows, src_sum{i}, tgt_sum{i}, src_fp, tgt_fp: a projection
    of each side and one global aggregate (partial per task) - no shuffle of the rows."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sums = list(dict.fromkeys(spec.sum_cols))
    both = lambda: (src.select(*sums, one.alias(SN), zero.alias(TN))
                    .unionByName(tgt.select(*sums, zero.alias(SN), one.alias(TN))))
    if sums:                                   # a column's type is that of both sides together
        kinds = {c: both().schema[c].dataType for c in sums}
        src, tgt = (t.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()}) for t in (src, tgt))
    u = _weighted(src, spec, one, zero).unionByName(_weighted(tgt, spec, zero, one))
    exact = _exact_part(both(), spec, F.col(SN), F.col(TN)) if sums else None
    return _metrics_of(src, u if exact is None else u.unionByName(exact), spec)


def _row(check_type: str, metric: str, table_name: str, s: Column, t: Column,
         ok: Column, mismatch: Column) -> Column:
    return F.struct(
        F.lit(check_type).alias("check_type"), F.lit(table_name).alias("table_name"),
        F.lit(metric).alias("metric_name"),
        s.cast("string").alias("source_value"), t.cast("string").alias("target_value"),
        F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
        mismatch.cast("bigint").alias("mismatch_count"))


def _flag(ok: Column) -> Column:
    return F.when(ok, F.lit(0)).otherwise(F.lit(1))


def _count_row(spec: CheckSpec) -> Column:
    s, t = F.col("src_rows"), F.col("tgt_rows")
    return _row(ROW_COUNT, METRIC_ROW_COUNT, spec.table_name, s, t, s == t, F.abs(s - t))


def _sum_text(x: Column) -> Column:
    """Text of an exact double sum: two decimals where a decimal can hold it, else the double's own text."""
    return F.coalesce(F.when(F.abs(x) < 1e30, x.cast(AMOUNT_TEXT).cast("string")), x.cast("string"))


def _sum_rows(df: DataFrame, spec: CheckSpec) -> list[Column]:
    out = []
    for i, c in enumerate(spec.sum_cols):
        s, t = F.col(f"src_sum{i}"), F.col(f"tgt_sum{i}")
        if _is_double(df, c):
            ok = (F.abs(F.col(f"diff_sum{i}")) < F.lit(float(spec.tolerance))) & F.col(f"marks{i}")
            s, t = _sum_text(s), _sum_text(t)
        else:
            ok = F.abs(s - t) < F.lit(str(spec.tolerance)).cast("decimal(20,10)")
        out.append(_row(COLUMN_SUM, METRIC_SUM_PREFIX + c, spec.table_name, s, t, ok, _flag(ok)))
    return out


def _hash_row(spec: CheckSpec) -> Column:
    s, t = F.col("src_fp"), F.col("tgt_fp")
    ok = s.eqNullSafe(t)  # two empty tables agree
    return _row(COLUMN_HASH, METRIC_FINGERPRINT, spec.table_name, s, t, ok, _flag(ok))


def _diff_row(spec: CheckSpec, n_diff: Column) -> Column:
    return _row(RECORD_DIFF, METRIC_MISMATCHED, spec.table_name, F.col("src_rows"), F.col("tgt_rows"),
                n_diff == 0, n_diff)


def _emit(m: DataFrame, rows: list[Column], run_id: str, run_ts) -> DataFrame:
    out = m.select(F.inline(F.array(*rows)))
    return out.select(F.lit(run_id).alias("run_id"), _ts(run_ts).alias("run_ts"),
                      *CHECK_COLUMNS[2:])


def row_count_check(src: DataFrame, tgt: DataFrame, spec: CheckSpec, run_id: str, run_ts) -> DataFrame:
    return _emit(metrics(src, tgt, spec), [_count_row(spec)], run_id, run_ts)


def column_sum_check(src: DataFrame, tgt: DataFrame, spec: CheckSpec, run_id: str, run_ts) -> DataFrame:
    return _emit(metrics(src, tgt, spec), _sum_rows(src, spec), run_id, run_ts)


def fingerprint_check(src: DataFrame, tgt: DataFrame, spec: CheckSpec, run_id: str, run_ts) -> DataFrame:
    return _emit(metrics(src, tgt, spec), [_hash_row(spec)], run_id, run_ts)


# ---------------------------------------------------------------- record diff

# fixed values: hot-key salting of the versions-to-key-statistics join
HOT_KEYS_MAX = 10000       # a key is hot when it holds >= 1/HOT_KEYS_MAX of all versions
SPLIT_VERSIONS = 1 << 20   # versions per salt bucket of a hot key


def salted_join(rows: DataFrame, stats: DataFrame, key: str, size: Column,
                spread_cols: Sequence[str]) -> DataFrame:
    """``rows`` (many per key) joined with ``stats`` (one row per key, NULL key included:
    keys match null-safely), with hot keys split.

    A key whose ``size`` (rows it has in ``rows``) is at least 1/HOT_KEYS_MAX of the total
    and above one bucket is salted: its rows spread over ceil(size / SPLIT_VERSIONS) buckets
    by a hash of ``spread_cols``, and only its statistics row is repeated per bucket.  At most
    HOT_KEYS_MAX keys can pass that share test, so the hot-key list has a proven bound and is
    broadcast; every other key keeps bucket 0.  The join runs on (key, bucket), so one key
    holding a third of all rows still spreads over many tasks."""
    total = stats.select(F.sum(size)).scalar()
    hot = (stats.where((size * F.lit(HOT_KEYS_MAX) >= total) & (size > F.lit(SPLIT_VERSIONS)))
                .select(F.col(key).alias("__lc_hk"),
                        F.ceil(size / F.lit(SPLIT_VERSIONS)).cast("int").alias("__lc_parts")))
    hot = F.broadcast(hot)   # <= HOT_KEYS_MAX rows by construction
    parts = F.coalesce(F.col("__lc_parts"), F.lit(1)).cast("bigint")
    r = (rows.join(hot, rows[key].eqNullSafe(F.col("__lc_hk")), "left")
             .withColumn("__lc_b", F.pmod(F.xxhash64(F.col(key), *spread_cols), parts))
             .drop("__lc_hk", "__lc_parts"))
    st = (stats.join(hot, stats[key].eqNullSafe(F.col("__lc_hk")), "left")
               .withColumn("__lc_sb", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
               .drop("__lc_hk", "__lc_parts")
               .withColumnRenamed(key, "__lc_sk"))
    cond = F.col(key).eqNullSafe(F.col("__lc_sk")) & (F.col("__lc_b") == F.col("__lc_sb"))
    return r.join(st, cond, "inner").drop("__lc_b", "__lc_sb", "__lc_sk")


def diff_of_versions(v: DataFrame, key: str, cols: Sequence[str],
                     src_prefix: str = "src_", tgt_prefix: str = "tgt_") -> DataFrame:
    """Compact record diff from versions over (key, cols): key, src_*, tgt_*, ``n_rows``.

    * key on one side only, or NULL key: each version with a non-NULL value, other side NULL,
      ``n_rows`` = its copies;
    * one side of the key has a single version: that version paired with each differing
      version of the other side, ``n_rows`` = s * t pairs (the reference's rows);
    * several versions on both sides: each version listed once, other side NULL, ``n_rows``
      = its copies (the pairs would be a cross product; their number is in the check).

    The key statistics (one row per key) carry the key's version of a side when that side
    has only one, so a single many-to-one join of versions with their key's statistics
    yields every diff row: no self-join, output <= input, and hot keys are salted.  NULL
    keys form one statistics row whose version counts are zero, so its versions are listed
    one-sided and never paired."""
    cols = list(cols)
    if not cols:  # nothing to compare: no pair differs and one-sided rows are all-NULL
        return v.select(F.col(key), F.lit(0).cast("bigint").alias("n_rows")).where(F.lit(False))
    sn, tn = F.col(SN), F.col(TN)
    version = F.struct(*[F.col(c) for c in cols])
    real = F.col(key).isNotNull()
    stats = v.groupBy(key).agg(
        F.count(F.lit(1)).alias("__lc_v"),
        F.count_if(sn > 0).alias("__lc_ds"), F.count_if(tn > 0).alias("__lc_dt"),
        F.sum(sn).alias("__lc_m"), F.sum(tn).alias("__lc_n"),
        F.first(F.when(sn > 0, version), ignorenulls=True).alias("__lc_sv"),
        F.first(F.when(tn > 0, version), ignorenulls=True).alias("__lc_tv"))
    stats = (stats.withColumn("__lc_ds", F.when(real, F.col("__lc_ds")).otherwise(F.lit(0)))
                  .withColumn("__lc_dt", F.when(real, F.col("__lc_dt")).otherwise(F.lit(0))))
    none = F.lit(None).cast(stats.schema["__lc_sv"].dataType)
    vk = salted_join(v, stats, key, F.col("__lc_v"), cols)
    ds, dt = F.col("__lc_ds"), F.col("__lc_dt")
    anyv = _any_value(cols)

    def cand(ok: Column, s_ver: Column, t_ver: Column, n: Column) -> Column:
        return F.when(ok, F.struct(s_ver.alias("s"), t_ver.alias("t"), n.cast("bigint").alias("n")))

    many = (ds >= 2) & (dt >= 2)
    candidates = F.array(
        # one-sided (incl. NULL key) or many-to-many: the version itself, per side
        cand((sn > 0) & (((dt == 0) & anyv) | many), version, none, sn),
        cand((tn > 0) & (((ds == 0) & anyv) | many), none, version, tn),
        # a single target version: each source version against it
        cand((sn > 0) & (dt == 1) & (ds >= 1), version, F.col("__lc_tv"), sn * F.col("__lc_n")),
        # a single source version, several target versions: it against each of them
        cand((tn > 0) & (ds == 1) & (dt >= 2), F.col("__lc_sv"), version, tn * F.col("__lc_m")))
    # explode the fixed-size array and drop the empty slots (no lambda: stays in codegen)
    rows = vk.select(key, F.explode(candidates).alias("__lc_r")).where(F.col("__lc_r").isNotNull())
    s_ver, t_ver = F.col("__lc_r.s"), F.col("__lc_r.t")
    differs = any_differs([(s_ver[c], t_ver[c]) for c in cols])
    return (rows.where(s_ver.isNull() | t_ver.isNull() | differs)
                .select(key, *[s_ver[c].alias(f"{src_prefix}{c}") for c in cols],
                        *[t_ver[c].alias(f"{tgt_prefix}{c}") for c in cols],
                        F.col("__lc_r.n").alias("n_rows")))


def record_diff(src: DataFrame, tgt: DataFrame, key: str, cols: Sequence[str],
                src_prefix: str = "src_", tgt_prefix: str = "tgt_") -> DataFrame:
    """Compact diff of ``src`` and ``tgt`` on ``key`` over ``cols`` (see ``diff_of_versions``)."""
    cols = list(cols)
    return diff_of_versions(versions(src, tgt, [key, *cols]), key, cols, src_prefix, tgt_prefix)


EXPAND_CHUNK = 4096  # copies per generated array when a compact row is expanded to rows


def expand_diff(diff: DataFrame) -> DataFrame:
    """Row-level diff: ``n_rows`` copies of each compact row.  Copies are generated in two
    levels (chunks of ``EXPAND_CHUNK``), so no single array grows with ``n_rows``.  Only for
    bounded inputs (the capped details); the compact form is the result at scale."""
    n = F.col("n_rows")
    cols = [c for c in diff.columns if c != "n_rows"]
    chunks = F.ceil(n / F.lit(EXPAND_CHUNK)).cast("int")
    step1 = diff.filter(n > 0).select(*cols, n.alias("__lc_n"),
                                      F.explode(F.sequence(F.lit(0), chunks - 1)).alias("__lc_c"))
    size = F.least(F.lit(EXPAND_CHUNK), F.col("__lc_n") - F.col("__lc_c") * EXPAND_CHUNK).cast("int")
    return step1.select(*cols, F.explode(F.array_repeat(F.lit(0), size)).alias("__lc_x")).drop("__lc_x")


def record_diff_check(src: DataFrame, tgt: DataFrame, spec: CheckSpec, run_id: str, run_ts) -> DataFrame:
    return run_checks(src, tgt, spec, run_id, run_ts, only=(RECORD_DIFF,))


def diff_details(diff: DataFrame, key: str, run_id: str, n: int | None = None) -> DataFrame:
    """The row-level differences tagged with the run id: all of them, or the first ``n`` in key order (then all columns:
    a total order) - a top-n, not an arbitrary ``limit``.

    Every compact row stands for at least one row and its copies are identical, so the first
    n rows come from the first n compact rows.  Those (at most n, one partition after the
    top-n) get a running count, and each is expanded only to the rows still missing: at most
    n rows are ever generated."""
    if n is None:
        return expand_diff(diff).withColumn("run_id", F.lit(run_id))
    order = [F.col(key).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in diff.columns
                                             if c not in (key, "n_rows")]
    top = diff.filter(F.col("n_rows") > 0).orderBy(*order).limit(n)
    before = F.coalesce(F.sum("n_rows").over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    take = F.least(F.col("n_rows"), F.lit(n) - before)
    bounded = top.withColumn("n_rows", take)
    return expand_diff(bounded).withColumn("run_id", F.lit(run_id))


def details_of_versions(v: DataFrame, key: str, cols: Sequence[str], run_id: str, n: int | None = None,
                        src_prefix: str = "src_", tgt_prefix: str = "tgt_") -> DataFrame:
    """``diff_details`` of versions; with ``n``, without diffing every key.  A key has diff rows exactly when its
    differing-pair count is positive, and each such key gives at least one row, so the first
    n rows in key order come from the first n such keys.  Those keys are a top-n over the key
    statistics (at most n rows, broadcast); the versions are semi-joined with them map-side,
    and only that selection is diffed."""
    cols = list(cols)
    if n is None:
        return diff_details(diff_of_versions(v, key, cols, src_prefix, tgt_prefix), key, run_id)
    keys = (key_stats(v, key, cols).where(F.col("__lc_d") > 0)
            .select(F.col(key).alias("__lc_dk")).orderBy(F.col("__lc_dk").asc_nulls_last()).limit(n))
    chosen = v.join(F.broadcast(keys), v[key].eqNullSafe(F.col("__lc_dk")), "left_semi")  # <= n keys
    return diff_details(diff_of_versions(chosen, key, cols, src_prefix, tgt_prefix), key, run_id, n)


# ---------------------------------------------------------------- all checks

def run_checks(src: DataFrame, tgt: DataFrame, spec: CheckSpec, run_id: str, run_ts,
               v: DataFrame | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """The check rows of one run (ROW_COUNT, one COLUMN_SUM per sum column, COLUMN_HASH,
    RECORD_DIFF) from one aggregate.

    Both sides are grouped together once by every column any check needs (``versions``);
    the versions feed the metrics (count = sum n, sums = sum v*n, fingerprint = sum h*n -
    all exact) and the key-level diff count.  Pass ``v`` (e.g. checkpointed, to share it
    with the diff details) to skip the grouping."""
    cols = check_columns(spec)
    if v is None:
        v = versions(src, tgt, cols)
    wanted = [only is None or k in only for k in (ROW_COUNT, COLUMN_SUM, COLUMN_HASH, RECORD_DIFF)]
    u = _weighted(v, spec, F.col(SN), F.col(TN))
    exact = _exact_part(v, spec, F.col(SN), F.col(TN)) if wanted[1] else None
    if exact is not None:
        u = u.unionByName(exact)
    if wanted[3]:
        dv = narrow_versions(v, [spec.key, *spec.compare_cols])
        u = u.unionByName(_diff_part(v, diff_count_rows(dv, spec.key, list(spec.compare_cols)), spec))
    rows = [[_count_row(spec)], _sum_rows(v, spec), [_hash_row(spec)], [_diff_row(spec, F.col("n_diff"))]]
    return _emit(_metrics_of(v, u, spec), [r for w, rs in zip(wanted, rows) if w for r in rs], run_id, run_ts)
