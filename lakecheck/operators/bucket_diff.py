"""Localised record diff: a two-level tree of bucket fingerprints finds where two tables differ, and only the rows of
leaves that differ are grouped and compared.

A key's hash names its leaf: the upper digits a bucket, the lower ones a leaf within it.  A bucket's fingerprint is the
sum over its rows of 128 hash bits of the row's text, source rows counted plus and target rows minus, with the signed
number of rows.  The text is unambiguous (NULL is a mark, every other value is led by its length), so a bucket whose
sums are all zero holds the same rows with the same copies on both sides, up to a 128-bit collision; any difference of
values that compare as equal (0.0 and -0.0) only makes a leaf be looked at in vain.

1. One aggregate per bucket over both tables (map-side combined: a task sends one row a bucket, whatever it reads).
2. The unequal buckets, at most ``fanout`` of them, are broadcast; only their rows are summed again, by leaf.
3. The unequal leaves become bit masks, 32 leaves to a row, so at most ``MAX_LEAVES`` / 32 rows are broadcast; both
   tables are semi-joined with them map-side, and what is left goes through ``recon.record_diff``.

So the rows that are shuffled are those that share a leaf with a difference: a part 1 - (1 - f)^r of all rows for a
part f of changed rows in leaves of r rows.  The tables are scanned three times, with the compared columns only.
A key (NULL too) that has the same rows on both sides, however many versions, is no difference here; in ``recon.record_diff``
the versions of a key that has several on both sides, and NULL keys, are listed even then, as the reference's join does.
Tables that differ everywhere are better compared by ``recon.record_diff`` at once, which scans them once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecheck.operators import recon
from lakecheck.session import scratch_path
from lakecheck.sinks import writers

ROWS_PER_LEAF = 64        # aimed at; fewer rows a leaf move fewer equal rows, but cost a longer list of leaves
MAX_LEAVES = 1 << 24      # leaves of a tree, at most; bounds the broadcast masks (2^19 rows)
MASK = 32                 # leaves that one mask row covers
_B, _L, _W, _M = "__lc_bucket", "__lc_leaf", "__lc_word", "__lc_mask"
_PARTS = ["__lc_n", "__lc_h0", "__lc_h1", "__lc_h2", "__lc_h3"]


def fanout_for(rows: int, rows_per_leaf: int = ROWS_PER_LEAF) -> int:
    """Buckets, and leaves of a bucket (the same power of two), for this many rows."""
    leaves = max(1, min(MAX_LEAVES, -(-rows // rows_per_leaf)))
    bits = max(leaves - 1, 1).bit_length()
    return 1 << max(3, (bits + 1) // 2)


def _place(key: str, fanout: int) -> tuple[Column, Column]:
    h = F.xxhash64(F.col(key))
    bits = fanout.bit_length() - 1
    return (F.pmod(F.shiftrightunsigned(h, bits), F.lit(fanout)).cast("int"), F.pmod(h, F.lit(fanout)).cast("int"))


def row_text(df: DataFrame, cols: Sequence[str]) -> Column:
    """Unambiguous text of a row: ``-`` for NULL, else length, colon and value."""
    out = []
    for c in cols:
        kind = df.schema[c].dataType
        v = F.col(c)
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            v = F.to_json(F.struct(v))
        elif isinstance(kind, T.BinaryType):
            v = F.hex(v)
        text = v.cast("string")
        out.append(F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text)))
    return F.concat(*out)


def _signed(df: DataFrame, key: str, cols: Sequence[str], fanout: int, sign: int) -> DataFrame:
    """(bucket, leaf, row count, four 32-bit hash parts) of each row, with the side's sign."""
    bucket, leaf = _place(key, fanout)
    text = row_text(df, [key, *cols])
    hashed = df.select(bucket.alias(_B), leaf.alias(_L), F.xxhash64(text).alias("__lc_x"), F.xxhash64(F.lit("second"), text).alias("__lc_y"))
    low = F.lit(0xFFFFFFFF)
    parts = [F.col("__lc_x").bitwiseAND(low), F.shiftrightunsigned("__lc_x", 32), F.col("__lc_y").bitwiseAND(low), F.shiftrightunsigned("__lc_y", 32)]
    s = F.lit(sign).cast("bigint")
    return hashed.select(_B, _L, s.alias(_PARTS[0]), *[(p * s).alias(n) for p, n in zip(parts, _PARTS[1:])])


def _unequal(rows: DataFrame, *by: str) -> DataFrame:
    sums = rows.groupBy(*by).agg(*[F.sum(p).alias(p) for p in _PARTS])
    differs = F.lit(False)
    for p in _PARTS:
        differs = differs | (F.col(p) != 0)
    return sums.where(differs).select(*by)


def unequal_leaves(src: DataFrame, tgt: DataFrame, key: str, cols: Sequence[str], fanout: int) -> DataFrame:
    """(bucket, leaf) of the leaves whose rows differ between the sides."""
    rows = _signed(src, key, cols, fanout, 1).unionByName(_signed(tgt, key, cols, fanout, -1))
    buckets = _unequal(rows, _B)                                              # at most fanout rows
    return _unequal(rows.join(F.broadcast(buckets), _B, "left_semi"), _B, _L)


def rows_of_leaves(df: DataFrame, leaves: DataFrame, key: str, fanout: int) -> DataFrame:
    """The rows of ``df`` whose key falls into one of ``leaves``, chosen before any shuffle."""
    bit = F.expr(f"shiftleft(1L, {_L} % {MASK})")
    masks = leaves.groupBy(_B, F.floor(F.col(_L) / MASK).cast("int").alias(_W)).agg(F.bit_or(bit).alias(_M))
    bucket, leaf = _place(key, fanout)
    placed = df.withColumns({_B: bucket, _L: leaf}).withColumn(_W, F.floor(F.col(_L) / MASK).cast("int"))
    masks = F.broadcast(masks)                                                # at most MAX_LEAVES / MASK rows
    hit = placed.join(masks, [_B, _W]).where(F.expr(f"getbit({_M}, {_L} % {MASK}) = 1"))
    return hit.select(*df.columns)


def bucket_diff(src: DataFrame, tgt: DataFrame, key: str, cols: Sequence[str], fanout: int | None = None,
                src_prefix: str = "src_", tgt_prefix: str = "tgt_") -> DataFrame:
    """The rows of ``recon.record_diff`` for the keys whose rows differ, found through the tree.  ``src`` and ``tgt`` should be
    stored tables: they are read three times.  Without ``fanout``, it is chosen by the larger table's row count
    (Parquet footers)."""
    cols = list(cols)
    if fanout is None:
        fanout = fanout_for(max(src.count(), tgt.count()))
    if fanout & (fanout - 1) or fanout * fanout > MAX_LEAVES:
        raise ValueError("fanout is a power of two of at most sqrt(MAX_LEAVES)")
    wanted = [key, *cols]
    src, tgt = src.select(*wanted), tgt.select(*wanted)
    # written once: both sides are chosen by them
    leaves = writers.materialize(unequal_leaves(src, tgt, key, cols, fanout), scratch_path(src.sparkSession, "unequal-leaves"))
    v = recon.versions(rows_of_leaves(src, leaves, key, fanout), rows_of_leaves(tgt, leaves, key, fanout), wanted)
    keys = v.groupBy(F.col(key).alias("__lc_dk")).agg(F.max(F.col(recon.SN) != F.col(recon.TN)).alias("__lc_d")).where("__lc_d")
    v = v.join(keys, v[key].eqNullSafe(F.col("__lc_dk")), "left_semi")
    return recon.diff_of_versions(v, key, cols, src_prefix, tgt_prefix)
