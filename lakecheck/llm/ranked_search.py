"""Ranked lexical search with hashed max-sketches.

Every document keeps its distinct terms with their counts, and a sketch: each term's impact (its saturated,
length-normalised count) is rounded up to one of 255 levels and folded by coordinatewise maximum into the
coordinate that the term's hash names.  A sketch has at least ``SPREAD`` coordinates a distinct term, a power of two, so
long documents are bounded as tightly as short ones.  The sum of an item's term weights times the levels at their
coordinates is never below the item's score of the document.  Tasks look a block of items up in a batch of sketches at
a time, then score documents exactly from their terms in descending order of the bounds, until no bound
reaches the item's k-th score so far; so only each task's k best documents an item are shuffled.

Document counts of the items' terms are a join and a grouped count over all documents.  Items are worked in blocks
of ``BLOCK``, the only data that leaves Spark's tables.

Defined cases: texts that are NULL or without a term take no part; items without one have no rows; repeated rows
of documents or items count as documents and items of their own; documents with equal scores are ordered by id, NULL
ids last; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecheck.llm import common as C
from lakecheck.operators.numbering import number_rows

K1, B = 800, 75            # thousandths, hundredths: the saturation 0.8 and the length part 0.75
SCALE = 1_000_000          # an impact lies below it
SPREAD = 4                 # coordinates of a sketch for each distinct term, at least
LEAST = 64                 # coordinates of the smallest sketch
CHUNK = 1024               # documents whose sketches are looked up together
BLOCK = 512                # items searched together

_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_PROFILE = "doc_id long, n long, terms string, tf binary"
_INDEX = "doc_id long, m long, terms string, tf binary, sketch binary"


def terms(text: bytes) -> list[bytes]:
    """The maximal runs of ASCII letters and digits and of longer characters, A-Z lower-cased."""
    return text.translate(_TERM).split()


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> one row per document with terms: its distinct terms, parted by spaces, and their counts."""
    for b in batches:
        ids = b.column(0)
        for i, j, data, off in C.text_chunks(b.column(1), 4 * C.CHUNK_BYTES):
            whole, out = data.tobytes(), ([], [], [], [])
            for x in range(j - i):
                found = terms(whole[off[x]:off[x + 1]])
                if found:
                    count = Counter(found)
                    for c, v in zip(out, (i + x, len(found), b" ".join(count).decode(), np.fromiter(count.values(), "<i8").tobytes())):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
                                              pa.array(out[3], pa.binary())], ["doc_id", "n", "terms", "tf"])


def impact(tf, m):
    return (1000 * SCALE * tf) // (1000 * tf + K1 // 100 * m)


def coordinates(words: list[bytes], width: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & (width - 1)


def sketch(words: list[bytes], tf: np.ndarray, m: int) -> np.ndarray:
    """Coordinatewise maxima of the terms' impacts, as levels of 255 rounded up."""
    level = -(-impact(tf, m) * 255 // SCALE)
    out = np.zeros(max(LEAST, 1 << (SPREAD * len(words) - 1).bit_length()), dtype=np.uint8)
    order = np.argsort(level, kind="stable")
    out[coordinates(words, len(out))[order]] = level[order]          # the last, highest one stays
    return out


def _sketches(documents: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ms, made = [], []
            for n, words, tf in zip(b.column(1).to_pylist(), b.column(2), b.column(3)):
                m = 100 - B + (B * n * documents) // length
                ms.append(m)
                made.append(sketch(words.as_py().encode().split(b" "), np.frombuffer(tf.as_py(), "<i8"), m).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ms, pa.int64()), b.column(2), b.column(3), pa.array(made, pa.binary())],
                                             ["doc_id", "m", "terms", "tf", "sketch"])
    return run


class _Searcher:
    """The best documents of every item of a block among the documents seen."""

    def __init__(self, block: list[tuple[int, list[tuple[bytes, int]]]], k: int):
        self.k = k
        self.items = [(key, of, [t for t, _ in of], np.array([w for _, w in of], dtype=np.float32), 1 + (len(of) + 4) * 2e-7) for key, of in block]
        self.best: list[list] = [[] for _ in block]
        self.at: dict[int, list[np.ndarray]] = {}

    def add(self, ids: list, ms: list[int], words: list[bytes], tfs: list[bytes], sketches: list[bytes]) -> None:
        widths = np.fromiter(map(len, sketches), np.int64, len(sketches))
        counts: dict[int, dict] = {}

        def score(d: int, of: list[tuple[bytes, int]]) -> int:
            have = counts.get(d)
            if have is None:
                have = counts[d] = dict(zip(words[d].split(b" "), np.frombuffer(tfs[d], "<i8").tolist()))
            return sum(w * impact(have[t], ms[d]) for t, w in of if t in have)

        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            if width not in self.at:
                self.at[width] = [coordinates(t, width) for _, _, t, _, _ in self.items]
            levels = np.frombuffer(b"".join(sketches[d] for d in rows), np.uint8).reshape(len(rows), width).T.astype(np.float32)
            for (_, of, _, weight, slack), at, best in zip(self.items, self.at[width], self.best):
                bound = (weight @ levels[at]).astype(np.float64) * (slack * SCALE / 255)
                least = -best[-1][0] if len(best) == self.k else 1
                near = np.flatnonzero(bound >= least)
                for x in near[np.argsort(-bound[near], kind="stable")].tolist():
                    if len(best) == self.k and bound[x] < -best[-1][0]:
                        break
                    d = int(rows[x])
                    if s := score(d, of):
                        found = (-s, ids[d] is None, ids[d] or 0)
                        if len(best) < self.k or found < best[-1]:
                            bisect.insort(best, found)
                            del best[self.k:]

    def rows(self) -> pa.RecordBatch:
        flat = [(key, None if none else i, -s) for (key, *_), best in zip(self.items, self.best) for s, none, i in best]
        return pa.RecordBatch.from_arrays([pa.array([f[c] for f in flat], pa.int64()) for c in range(3)], ["key", "doc_id", "score"])


def _search(block: list[tuple[int, list[tuple[bytes, int]]]], k: int):
    """Rows of an index -> the task's k best (key, doc_id, score) of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _Searcher(block, k)
        for b in batches:
            for s in range(0, b.num_rows, CHUNK):
                ids, ms, words, tfs, sketches = (b.column(c).slice(s, CHUNK).to_pylist() for c in range(5))
                searcher.add(ids, ms, [w.encode() for w in words], tfs, sketches)
        yield searcher.rows()
    return run


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """The stored index (doc_id, m, terms, tf, sketch) and profiles of the documents with terms, and their number."""
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    profiles = C.stored(text.mapInArrow(_profiles, _PROFILE), "profiles")
    n = profiles.agg(F.count("*"), F.sum("n")).first()
    return C.stored(profiles.mapInArrow(_sketches(n[0], n[1] or 1), _INDEX), "sketches"), profiles, n[0]


def weighted_items(items: DataFrame, profiles: DataFrame, documents: int, id_col: str, text_col: str) -> DataFrame:
    """(key, item_id, term, weight): the terms of each item, numbered from 1, and their weights times their repeats."""
    rows = C.stored(number_rows(items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text")), ["item_id", "text"], "key"), "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = [(key, t.decode(), c) for key, text in zip(*(b.column(x).to_pylist() for x in (0, 1))) for t, c in Counter(terms(text.encode())).items()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int64()), pa.array([f[1] for f in flat], pa.string()),
                                              pa.array([f[2] for f in flat], pa.int64())], ["key", "term", "c"])
    of = C.stored(rows.where("text is not null").select("key", "text").mapInArrow(run, "key long, term string, c long"), "item-terms")
    asked = of.select("term").distinct()
    df = profiles.select(F.explode(F.split("terms", " ")).alias("term")).join(asked, "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    w = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("long")
    return C.stored(of.join(df, "term").join(rows.select("key", "item_id"), "key").select("key", "item_id", "term", (w * F.col("c")).alias("weight")), "weights")


def search(docs: DataFrame, items: DataFrame, k: int = 10, item_col: str = "item_id", item_text: str = "text", **columns) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0."""
    made, profiles, documents = index(docs, **columns)
    weights = weighted_items(items, profiles, documents, item_col, item_text)
    last = weights.agg(F.max("key")).first()[0] or 0
    found = docs.sparkSession.createDataFrame([], "key long, doc_id long, score long")
    for start in range(1, last + 1, BLOCK):
        block: dict[int, list] = {}
        for r in weights.where(F.col("key").between(start, start + BLOCK - 1) & (F.col("weight") > 0)).select("key", "term", "weight").collect():
            block.setdefault(r["key"], []).append((r["term"].encode(), r["weight"]))
        found = found.union(made.select("doc_id", "m", "terms", "tf", "sketch").mapInArrow(_search(sorted(block.items()), k), "key long, doc_id long, score long"))
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(weights.select("key", "item_id").distinct(), "key").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
