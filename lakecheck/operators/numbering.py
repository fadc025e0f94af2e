"""Scalable dense numbering: the result of ``row_number() OVER (ORDER BY cols)`` without
sending every row to one task.

A global ``Window.orderBy`` plans ``Exchange SinglePartition``.  Instead:

1. range-partition by the order columns into ``buckets`` partitions (Spark samples the
   bounds over the whole key tuple, so a heavy first column is still split by the rest);
2. sort within each partition and take the in-partition position from
   ``monotonically_increasing_id`` (partition index in the upper bits, position below);
3. checkpoint that result once (reliable checkpoint in the shared folder): the per-partition
   counts and the rows must come from the *same* range partitioning, and two separately
   planned range exchanges sample different bounds (the sampler is seeded by RDD id);
4. count rows per partition (an aggregate over at most ``buckets`` groups), turn the
   counts into running offsets with a window over that tiny table, and broadcast it back
   (size bound: ``buckets`` rows, never data-dependent).

Ties in the order columns are broken by ``xxhash64`` of the whole row, then by the row id
(``tiebreak=True``): distinct rows get a repeatable order, and one order value - or one
group of identical copies - that holds a third of all rows is still spread over many range
partitions instead of one task.  A lost executor cannot
change the numbering: the checkpointed partitions are read back from shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecheck.session import ensure_checkpoint_dir

_P, _M, _N, _OFF, _TB, _ID = "__lc_p", "__lc_m", "__lc_n", "__lc_off", "__lc_tb", "__lc_id"
_POS_BITS = 33  # monotonically_increasing_id keeps the in-partition position in the low 33 bits


def number_rows(df: DataFrame, order: Sequence[str], out_col: str,
                offset: Column | int = 0, buckets: int | None = None,
                tiebreak: bool = True) -> DataFrame:
    """Add ``out_col`` = offset + 1-based position of the row in ``order`` (ascending,
    NULLs first, as ``ORDER BY``).  ``offset`` may be a scalar-subquery column."""
    spark = df.sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = df.columns
    order = list(order)
    if tiebreak:
        # distinct rows are ordered by their hash; exact copies (identical hash) by their row
        # id, so a group of copies that holds a third of all rows still spreads over many
        # range partitions.  The numbering stays exact whatever the spread: counts and
        # positions come from the one checkpointed partitioning below.
        # the row id is taken after a local sort by (hash, row): identical rows are
        # interchangeable, so every input partition yields the same (row, id) pairs when a
        # lost task is recomputed, and the range routing below stays deterministic
        sortable = [c for c in cols if not isinstance(df.schema[c].dataType, T.MapType)]
        df = (df.withColumn(_TB, F.xxhash64(*cols))
                .sortWithinPartitions(_TB, *sortable)
                .withColumn(_ID, F.monotonically_increasing_id()))
        order = order + [_TB, _ID]
    ensure_checkpoint_dir(spark)
    located = (df.repartitionByRange(buckets, *order)
                 .sortWithinPartitions(*order)
                 .withColumn(_P, F.spark_partition_id())
                 .withColumn(_M, F.monotonically_increasing_id() - F.shiftleft(
                     F.spark_partition_id().cast("bigint"), _POS_BITS))
                 .select(*cols, _P, _M)
                 .checkpoint(eager=True))
    counts = located.groupBy(_P).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_P, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    off = offset if isinstance(offset, Column) else F.lit(offset)
    numbered = located.join(F.broadcast(offsets), _P)
    out = numbered.withColumn(out_col, (F.col(_OFF) + F.col(_M) + 1 + off).cast("bigint"))
    return out.select(*cols, out_col)
