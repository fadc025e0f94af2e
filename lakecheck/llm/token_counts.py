"""Token counts by a separator scan of flat, unindexed token files.

A token file is a run of token ids in which an end-of-document id closes each document; nothing says where
documents begin.  It is held as a table of fixed-size blocks (shard, block, ids as little-endian bytes), the
form in which Spark can split a file of any size.  Each block is scanned on its own with a vectorised search for
the separator; a prefix scan over the blocks' summaries (tokens, separators, last separator) stitches
documents that cross block edges and numbers the documents of a shard.

Defined cases: two separators in a row enclose a document of 0 tokens; tokens after a shard's last separator are a
last document with closed = false; an empty block adds nothing; blocks may differ in size; a shard without
separators is one open document; an empty table gives no rows.  ``write_stream``: NULL and empty texts are documents of
0 tokens, and NULL or repeated ids are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakecheck.llm import common as C
from lakecheck.llm.tokens import encoder

SEPARATOR = 50256      # the vocabulary's end-of-text id
BLOCK = 1 << 16        # tokens of a block


def _stream(block: int, separator: int, width: str, path: str | None):
    """(id, text) -> blocks of one flat stream per task (shard, block, ids), and the ids of its documents in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, at, seen = encoder(path), TaskContext.get().partitionId(), 0, 0
        left = np.zeros(0, dtype=width)
        names = ["shard", "seq", "ids", "docs"]
        for b in batches:
            parts = [left]
            for text in b.column(1):
                text = text.as_py()
                if text:
                    parts.append(enc.plain_ids(text).astype(width))
                parts.append(np.array([separator], dtype=width))
            left = np.concatenate(parts)
            full = len(left) // block
            blocks = [left[k * block:(k + 1) * block].tobytes() for k in range(full)]
            left = left[full * block:]
            n = len(blocks)
            yield pa.RecordBatch.from_arrays([pa.array([shard] * (n + 1), pa.int32()), pa.array([*range(at, at + n), seen], pa.int64()),
                                              pa.array([*blocks, None], pa.binary()),
                                              pa.array([None] * n + [b.column(0).to_pylist()], pa.list_(pa.int64()))], names)
            at, seen = at + n, seen + b.num_rows
        if len(left):
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([at], pa.int64()), pa.array([left.tobytes()], pa.binary()),
                                              pa.array([None], pa.list_(pa.int64()))], names)
    return run


def write_stream(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, separator: int = SEPARATOR,
                 width: str = "<u2", path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Token blocks (shard, block, ids), and the manifest (shard, ordinal, id) of the documents' order."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    s = C.stored(d.mapInArrow(_stream(block, separator, width, path), "shard int, seq long, ids binary, docs array<long>"), "token-stream")
    blocks = s.where("ids is not null").select("shard", F.col("seq").alias("block"), "ids")
    manifest = s.where("docs is not null").select("shard", "seq", F.posexplode("docs").alias("i", "id")).select(
        "shard", (F.col("seq") + F.col("i")).alias("ordinal"), "id")
    return blocks, manifest


def read_files(spark: SparkSession, path: str, block: int = BLOCK, width: str = "<u2") -> DataFrame:
    """Blocks of binary token files (each at most 2 GB), one shard per file.  A file's number is its rank by path."""
    size = block * np.dtype(width).itemsize
    f = spark.read.format("binaryFile").load(path).select("path", "content", "length")
    names = f.select("path").withColumn("shard", (F.row_number().over(Window.orderBy("path")) - 1).cast("int"))
    n = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size)))
    cut = f.select("path", "content", F.explode(n).alias("block"))
    return cut.join(names, "path").select("shard", "block", F.expr(f"substring(content, int(block * {size} + 1), {size})").alias("ids"))


def _scan(separator: int, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, first, last, gaps = [], [], [], []
            for x in b.column(2):
                ids = np.frombuffer(x.as_py() or b"", dtype=width)
                at = np.flatnonzero(ids == separator)
                n.append(len(ids))
                first.append(int(at[0]) if len(at) else None)
                last.append(int(at[-1]) if len(at) else None)
                gaps.append((np.diff(at) - 1).tolist() if len(at) else [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, pa.int64()) for c in (n, first, last)],
                                              pa.array(gaps, pa.list_(pa.int64()))], ["shard", "block", "n", "first", "last", "gaps"])
    return run


def count_documents(blocks: DataFrame, separator: int = SEPARATOR, width: str = "<u2") -> DataFrame:
    """(shard, ordinal, n_tokens, closed) of every document in the blocks (shard, block, ids)."""
    b = C.stored(blocks.select("shard", "block", "ids").mapInArrow(
        _scan(separator, width), "shard int, block long, n long, first long, last long, gaps array<long>"), "block-summaries")
    w = Window.partitionBy("shard").orderBy("block")
    # prefix scan: where a block begins, how many separators come before it, and where the last of them is
    s = b.withColumn("begin", F.sum("n").over(w) - F.col("n"))
    s = s.withColumn("seps", F.when(F.col("first").isNull(), 0).otherwise(F.size("gaps") + 1))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("ordinal", F.coalesce(F.sum("seps").over(before), F.lit(0)))
    s = s.withColumn("prev", F.coalesce(F.max(F.col("begin") + F.col("last")).over(before), F.lit(-1)))
    closed = s.where("first is not null").select("shard", "ordinal", F.posexplode(F.concat(
        F.array(F.col("begin") + F.col("first") - F.col("prev") - 1), F.col("gaps"))).alias("i", "n_tokens")).select(
        "shard", (F.col("ordinal") + F.col("i")).cast("long").alias("ordinal"), "n_tokens", F.lit(True).alias("closed"))
    tail = b.groupBy("shard").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("first").isNull(), 0).otherwise(F.size("gaps") + 1)).alias("ordinal"))
    end = s.groupBy("shard").agg(F.max(F.greatest(F.col("prev"), F.coalesce(F.col("begin") + F.col("last"), F.lit(-1)))).alias("prev"))
    open_ = tail.join(end, "shard").select("shard", F.col("ordinal").cast("long"), (F.col("n") - F.col("prev") - 1).alias("n_tokens"),
                                           F.lit(False).alias("closed")).where("n_tokens > 0")
    return closed.union(open_)


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, path: str | None = None) -> DataFrame:
    """(id, n_tokens, shard, ordinal) of every document, counted in the flat files made of them."""
    blocks, manifest = write_stream(docs, id_col, text_col, block, path=path)
    return count_documents(blocks).join(manifest, ["shard", "ordinal"]).select(F.col("id").alias(id_col), "n_tokens", "shard", "ordinal")
