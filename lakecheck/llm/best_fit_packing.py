"""Best-fit packing of documents into sequences under several capacities.

An item is a vector (tokens, one document, attention cost = length squared), a sequence a capacity in each.
Items of one length are alike, so the packing is decided on the histogram of lengths, which has at most
``capacity`` rows whatever the corpus: lengths are taken from long to short, and each goes to the open bins
that can hold it under every constraint and whose residual after it has the least weighted norm (or whose
residual has the least weighted dot-product with it), one class of alike bins at a time.  The plan says which
ranks of a length go to which bins; Spark ranks the items of each length (bucketed, so that a hot length
is not one task) and joins them with the plan.  Token ids are made in one pass and never moved.

Defined cases: NULL and empty texts have only the end token; a longer document is cut into pieces of the
capacity, the first piece taking the rest; repeated rows are packed one by one; NULL ids are packed too
(their texts count); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecheck.llm import common as C
from lakecheck.llm.tokens import encoder

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
END = 2


@dataclass(frozen=True)
class Capacity:
    """Capacities of a sequence (None: open), and the weights and rule that choose among bins.  By default all three
    are finite and a sequence's tokens alone can fill it, so the rule weighs the three and none but tokens binds."""
    tokens: int = 1024
    documents: int | None = 1024
    cost: int | None = 1024 ** 2
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1)
    rule: str = "norm"

    def caps(self) -> list[int | None]:
        return [self.tokens, self.documents, self.cost]


def plan(histogram: dict[int, int], capacity: Capacity) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (length, first rank, end rank, first bin, offset): the ranks of a length lie in consecutive bins at this
    offset.  And the number of bins."""
    caps = capacity.caps()
    free: dict[tuple, list[tuple[int, int]]] = {}
    rows, bins = [], 0
    whole = tuple(caps)

    def item(n: int) -> tuple:
        return n, 1, n * n

    def fits(v: tuple, residual: tuple) -> int:
        return min(r // x for x, r in zip(v, residual) if r is not None)

    def value(v: tuple, residual: tuple) -> float:
        terms = [(w, x / c, r / c) for w, x, r, c in zip(capacity.weights, v, residual, caps) if c is not None]
        return sum(w * (r - x) ** 2 for w, x, r in terms) if capacity.rule == "norm" else sum(w * x * r for w, x, r in terms)

    for n in sorted(histogram, reverse=True):
        left, rank, v = histogram[n], 0, item(n)
        if not fits(v, whole):
            raise ValueError(f"an item of {n} tokens exceeds a sequence's capacity")
        while left:
            open_ = [r for r in free if fits(v, r)]
            if open_:
                residual = min(open_, key=lambda r: (value(v, r), r[0]))
                first, count = free[residual].pop()
                if not free[residual]:
                    del free[residual]
            else:
                residual, first = whole, bins
                count = -(-left // fits(v, whole))
                bins += count
            each = fits(v, residual)
            full = min(count, left // each)
            parts = [(first, full, each)] if full else []
            rest = left - full * each
            if full < count and rest:
                parts.append((first + full, 1, rest))
                full += 1
            if full < count:
                free.setdefault(residual, []).append((first + full, count - full))
            for at, m, k in parts:
                for j in range(k):
                    rows.append((n, rank, rank + m, at, caps[0] - residual[0] + j * n))
                    rank += m
                left -= m * k
                after = tuple(None if r is None else r - k * x for x, r in zip(v, residual))
                if after[0] > 0 and all(r is None or r > 0 for r in after):
                    free.setdefault(after, []).append((at, m))
    return rows, bins


def _pieces(capacity: int, end: int, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                ids = np.append(enc.ids(text) if text else np.zeros(0, dtype=np.uint32), np.uint32(end)).astype("<u4")
                rest = len(ids) % capacity or capacity
                cuts = [0, *range(rest, len(ids) + 1, capacity)]
                for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
                    for c, x in zip(out, (i, k, s, e - s, zlib.crc32(ids[s:e].tobytes()))):
                        c.append(x)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def assign(pieces: DataFrame, capacity: Capacity) -> DataFrame:
    """``pieces`` (with ``length``) plus sequence_id and offset.  ``pieces`` must be stored: it is read twice."""
    buckets = max(64, C.partitions(pieces))
    p = pieces.withColumn("__b", F.pmod(F.xxhash64(*[c for c in pieces.columns]), F.lit(buckets)))
    sizes = p.groupBy("length", "__b").agg(F.count("*").alias("n"))
    sizes = C.stored(sizes.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("__b")) - F.col("n")), "bucket-sizes")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row per length
    rows, _ = plan(histogram, capacity)
    table = C.stored(pieces.sparkSession.createDataFrame(rows, "length long, r0 long, r1 long, bin0 long, offset long"), "plan")
    order = Window.partitionBy("length", "__b").orderBy(*pieces.columns)
    ranked = (p.withColumn("__i", F.row_number().over(order) - 1)
              .join(C.bounded(sizes.select("length", "__b", "before")), ["length", "__b"])
              .withColumn("rank", F.col("before") + F.col("__i")))
    t = C.bounded(table).alias("t")
    q = ranked.alias("q")
    return q.join(t, (F.col("q.length") == F.col("t.length")) & (F.col("rank") >= F.col("r0")) & (F.col("rank") < F.col("r1"))).select(
        *[F.col(f"q.{c}") for c in pieces.columns], (F.col("bin0") + F.col("rank") - F.col("r0")).alias("sequence_id"), F.col("t.offset"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: Capacity = Capacity(), end: int = END,
         path: str | None = None) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if capacity.cost is not None and capacity.cost < capacity.tokens ** 2:
        longest = int(capacity.cost ** 0.5)            # no longer piece fits under the cost
    else:
        longest = capacity.tokens
    pieces = C.stored(d.mapInArrow(_pieces(longest, end, path), PIECE), "pieces")
    return assign(pieces, capacity).withColumnRenamed("doc_id", id_col)
