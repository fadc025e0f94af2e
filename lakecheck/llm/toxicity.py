"""Toxicity by class-conditional Kneser-Ney models.

Training texts give bigram counts per class (toxic, ordinary).  A word's Kneser-Ney probability in a
class comes from its continuation count, the number of distinct words it follows there, discounted and
interpolated with the continuation shares of both classes together:

    P_c(w) = max(t_c(w) - D, 0) / T_c + D * V_c / T_c * t(w) / T

A rare word leans on the shared backoff term; an unknown word, or one that follows fewer than ``min_types``
distinct words in all, has the backoff's weights alone, D * V_c / T_c.  A document has two features: the sum of
its words' log-likelihood differences over its word count, and the highest such mean of ``WINDOW`` consecutive
words (of the whole text if it is shorter), for a short expression in a long text.  A logistic curve in both maps them to
a score; a feature that would lower it is left out.  The curve is fitted on one fold of the learning rows, with features
by the counts of the others; the features that are scored then come from the counts of all of them.

The counts of all learning rows are gathered by a shuffle that grows with them, a slice of the words at a time where the
rows are stored; the calibration uses a histogram of features (bounded by its bins).  The model has a row per word; the ``MODEL_ROWS`` words that the learning
rows use most are broadcast (16 bytes each).  Of a larger model the other words, and unseen ones, are counted by document;
only these (document, word) counts are joined with it, and summed by document with what the broadcast words gave.
Texts are moved to be scored only for windows of more words, whose order counts.

Defined cases: empty, NULL and letter-less texts have features 0; without both classes in the learning
rows every score is 0; NULL labels teach nothing; of contradicting labels of a document the larger counts;
rows with NULL ids are scored but not learned from; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecheck.llm import common as C

DISCOUNT = 0.75
MIN_TYPES = 1          # every seen word has its own interpolated ratio
WINDOW = 1             # words of an expression (longer ones held out worse, see the README)
MODEL_ROWS = 2_000_000
FOLDS = 3              # one in so many learning rows calibrates
SLICES = 2             # of the words that are counted at a time
COUNT_BYTES = 2 << 20  # text counted together before rows are emitted
SUM_STEP = 2.0 ** 36   # ratios that are summed by a shuffle are multiples of 1 / SUM_STEP: the sum is the same in any order


def remainder(id_col: Column, k: int) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % k


def _bigrams(slice_: int, slices: int):
    """(text, toxic) -> (v, w, n0, n1): bigram counts per class, of every ``slices``-th word w by hash; a text's first word follows 0."""
    def flush(held):
        v, w, c = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((v, w))
        v, w, c = v[order], w[order], c[order]
        new = np.ones(len(v), dtype=bool)
        new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
        at = np.flatnonzero(new)
        one = np.add.reduceat(c, at) if len(at) else c
        n = np.diff(np.append(at, len(v)))
        return pa.RecordBatch.from_arrays([C.longs(v[at]), C.longs(w[at]), pa.array((n - one).astype(np.int32)), pa.array(one.astype(np.int32))],
                                          ["v", "w", "n0", "n1"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            toxic = b.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, off in C.text_chunks(b.column(0)):
                w, row = C.word_hashes(data, off, outside=C.NON_LETTER)
                if not len(w):
                    continue
                v = np.concatenate((w[:1], w[:-1]))
                v[np.concatenate(([True], row[1:] != row[:-1]))] = 0
                c = toxic[i:j][row].astype(np.int64)
                if slices > 1:
                    own = w % np.uint64(slices) == slice_
                    v, w, c = v[own], w[own], c[own]
                held.append((v, w, c))
                size += len(data)
                if size > COUNT_BYTES:
                    yield flush(held)
                    held.clear()
                    size = 0
        if held:
            yield flush(held)
    return run


def model(train: DataFrame, discount: float = DISCOUNT, min_types: int = MIN_TYPES, slices: int = 1) -> tuple[DataFrame, float]:
    """(w, ratio, n): log P_toxic(w) - log P_ordinary(w) of the seen words, and how often they occur; and the ratio of all others.
    Words are counted in ``slices``, one after the other, so that only one slice's pairs are on disk; each reads ``train`` again."""
    has = (F.col("n0") > 0).cast("int").bitwiseOR((F.col("n1") > 0).cast("int") * 2)
    t0, t1 = F.col("has").bitwiseAND(1), F.shiftright("has", 1)
    parts = []
    for k in range(slices):
        counts = train.select("text", "toxic").mapInArrow(_bigrams(k, slices), "v long, w long, n0 int, n1 int")
        pairs = counts.groupBy("w", "v").agg(F.bit_or(has).alias("has"), F.sum(F.col("n0") + F.col("n1")).alias("n"))
        parts.append(C.stored(pairs.groupBy("w").agg(F.sum(t0).alias("t0"), F.sum(t1).alias("t1"), F.count("*").alias("t"), F.sum("n").alias("n")), "words", clear=True))
    words = reduce(DataFrame.union, parts)
    s = words.agg(*[F.sum(x).alias(x) for x in ("t0", "t1", "t")], F.count(F.when(F.col("t0") > 0, 1)).alias("v0"),
                  F.count(F.when(F.col("t1") > 0, 1)).alias("v1")).first()
    if not s["t0"] or not s["t1"]:
        return words.select("w", F.lit(0.0).alias("ratio"), "n").limit(0), 0.0
    back = {c: discount * s[f"v{c}"] / s[f"t{c}"] for c in "01"}

    def p(c: str) -> Column:
        return F.greatest(F.col(f"t{c}") - discount, F.lit(0.0)) / s[f"t{c}"] + F.lit(back[c]) * F.col("t") / s["t"]
    return words.where(f"t >= {min_types}").select("w", (F.log(p("1")) - F.log(p("0"))).alias("ratio"), "n"), math.log(back["1"]) - math.log(back["0"])


def _measure(ratio: np.ndarray, row: np.ndarray, rows: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of each row's word ratios and the highest mean of ``window`` consecutive ones; 0 for a row without words."""
    mean, peak = np.zeros(rows), np.zeros(rows)
    if not len(ratio):
        return mean, peak
    n = np.bincount(row, minlength=rows)
    has = np.flatnonzero(n)
    first = (np.cumsum(n) - n)[has]
    mean[has] = np.add.reduceat(ratio, first) / n[has]
    size = np.minimum(n, window)[row]
    at = np.arange(len(ratio))
    whole = at - np.repeat(first, n[has]) >= size - 1                 # a whole window of the row ends here
    up = np.concatenate(([0.0], np.cumsum(ratio)))
    means = np.where(whole, (up[at + 1] - up[np.maximum(at + 1 - size, 0)]) / size, -np.inf)
    peak[has] = np.maximum.reduceat(means, first)
    return mean, peak


FEATURES = "id long, t long, feature double, peak double"


def _ratios(w: np.ndarray, hashes: np.ndarray, ratios: np.ndarray, other: float | np.ndarray) -> np.ndarray:
    if not len(hashes):
        return np.full(len(w), other)
    at = np.minimum(np.searchsorted(hashes, w), len(hashes) - 1)
    return np.where(hashes[at] == w, ratios[at], other)


def _lookup(hashes: np.ndarray, ratios: np.ndarray, other: float, window: int):
    shared = (hashes, ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, r = shared
        for b in batches:
            for i, j, data, off in C.text_chunks(b.column(1)):
                w, row = C.word_hashes(data, off, outside=C.NON_LETTER)
                mean, peak = _measure(_ratios(w, h, r, other), row, j - i, window)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(mean), pa.array(peak)],
                                                 ["id", "t", "feature", "peak"])
    return run


def _own_lookup(hashes: np.ndarray, ratios: np.ndarray, other: float, window: int):
    """(id, text, t, known): as ``_lookup``, each document also with the ratios of its own words."""
    shared = (hashes, ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                data, off = C.utf8(b.column(1).slice(k, 1))
                known = b.column(3).slice(k, 1).flatten()
                h = np.asarray(known.field("w").to_numpy(zero_copy_only=False), dtype=np.int64).view(np.uint64)
                r = np.asarray(known.field("ratio").to_numpy(zero_copy_only=False), dtype=float)
                order = np.argsort(h)
                w, row = C.word_hashes(data, off, outside=C.NON_LETTER)
                mean, peak = _measure(_ratios(w, h[order], r[order], _ratios(w, *shared, other)), row, 1, window)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(k, 1), b.column(2).slice(k, 1), pa.array(mean), pa.array(peak)],
                                                 ["id", "t", "feature", "peak"])
    return run


def _rest_counts(hashes: np.ndarray, ratios: np.ndarray):
    """(id, text, t) -> a row of each document, with k = 0, its words n, and the sum and maximum of the ratios of those among
    ``hashes``; and a row (id, t, w, k) of each of its other words w, which it has k times."""
    shared = (hashes, ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in C.text_chunks(b.column(1)):
                ids, t = (b.column(k).slice(i, j - i) for k in (0, 2))
                own = C.mix((ids.fill_null(0).to_numpy() ^ t.to_numpy()).view(np.uint64))     # many equal texts do not meet in one task
                w, row = C.word_hashes(data, off, outside=C.NON_LETTER)
                r = _ratios(w, *shared, np.nan)
                rest = np.isnan(r)
                total = np.bincount(row[~rest], weights=r[~rest], minlength=j - i).astype(float)    # whole numbers if there are none
                most = np.full(j - i, -np.inf)
                np.maximum.at(most, row[~rest], r[~rest])
                yield pa.RecordBatch.from_arrays([ids, t, C.longs(own), pa.array(np.zeros(j - i, dtype=np.int64)), C.longs(np.bincount(row, minlength=j - i)),
                                                  pa.array(total), pa.array(most)], REST)
                w, row = w[rest], row[rest]
                order = np.lexsort((w, row))
                w, row = w[order], row[order]
                new = np.ones(len(w), dtype=bool)
                new[1:] = (w[1:] != w[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(new)
                at, gone = pa.array(row[first]), len(first)
                yield pa.RecordBatch.from_arrays([ids.take(at), t.take(at), C.longs(w[first]), C.longs(np.diff(np.append(first, len(w)))),
                                                  pa.nulls(gone, pa.int64()), pa.nulls(gone, pa.float64()), pa.nulls(gone, pa.float64())], REST)
    return run


REST = ["id", "t", "w", "k", "n", "total", "most"]


def _rest_words(hashes: np.ndarray):
    """(id, text, t) -> (id, t, w): the distinct words of each document that are not among ``hashes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in C.text_chunks(b.column(1)):
                w, row = C.word_hashes(data, off, outside=C.NON_LETTER)
                rest = np.isnan(_ratios(w, hashes, np.zeros(len(hashes)), np.nan))
                w, row = w[rest], row[rest]
                order = np.lexsort((w, row))
                w, row = w[order], row[order]
                new = np.ones(len(w), dtype=bool)
                new[1:] = (w[1:] != w[:-1]) | (row[1:] != row[:-1])
                at = pa.array(row[new])
                yield pa.RecordBatch.from_arrays([*[b.column(k).slice(i, j - i).take(at) for k in (0, 2)], C.longs(w[new])], ["id", "t", "w"])
    return run


def _parts(words: DataFrame, model_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """The words that occur most, at most ``model_rows``, and the others, None if there are none."""
    if words.limit(model_rows + 1).count() <= model_rows:
        return words, None
    often = F.floor(F.log2("n") * 16)                    # equal numbers of occurrences are not parted
    sizes = words.groupBy(often.alias("often")).count().orderBy(F.desc("often")).collect()    # bounded: 16 for each doubling
    least, have = sizes[0]["often"] + 1, 0
    for r in sizes:
        have += r["count"]
        if have > model_rows:
            break
        least = r["often"]
    return words.where(often >= least), words.where(often < least)


def features(docs: DataFrame, words: DataFrame, other: float = 0.0, model_rows: int = MODEL_ROWS, window: int = WINDOW) -> DataFrame:
    """(id, t, feature, peak) of every document, t a hash of its text: the mean ratio of its words and of its highest window."""
    d = docs.select("id", "text", F.xxhash64("text").alias("t"))     # equal ids are told apart by their texts
    most, rest = _parts(words, model_rows)
    t = most.select("w", "ratio").toArrow()
    h = np.asarray(t.column("w").to_numpy()).view(np.uint64) if t.num_rows else np.zeros(0, dtype=np.uint64)
    order = np.argsort(h)
    r = t.column("ratio").to_numpy()[order] if t.num_rows else np.zeros(0)
    h = h[order]
    if rest is None:
        return d.mapInArrow(_lookup(h, r, other, window), FEATURES)
    if window > 1:                                                    # the words' order counts
        pairs = d.mapInArrow(_rest_words(h), "id long, t long, w long").distinct()
        known = pairs.join(rest, "w").groupBy("id", "t").agg(F.collect_list(F.struct("w", "ratio")).alias("known"))
        x, y = d.alias("x"), known.alias("y")
        return x.join(y, F.col("x.id").eqNullSafe(F.col("y.id")) & (F.col("x.t") == F.col("y.t")), "left").select(
            "x.id", "x.text", "x.t", "y.known").mapInArrow(_own_lookup(h, r, other, window), FEATURES)
    parts = d.mapInArrow(_rest_counts(h, r), "id long, t long, w long, k long, n long, total double, most double")
    ratio = F.when(F.col("k") > 0, F.coalesce("ratio", F.lit(other)))
    # a document that occurs ``rows`` times has the words of so many
    by_doc = parts.join(rest.select("w", "ratio"), "w", "left").groupBy("id", "t").agg(
        F.count(F.when(F.col("k") == 0, 1)).alias("rows"), F.max("n").alias("n"), F.max("total").alias("total"),
        F.coalesce(F.sum(F.col("k") * F.rint(ratio * SUM_STEP) / SUM_STEP), F.lit(0.0)).alias("more"), F.max(F.coalesce(ratio, "most")).alias("peak"))
    mean, some = (F.col("total") + F.col("more") / F.col("rows")) / F.col("n"), F.col("n") > 0
    return by_doc.select("id", "t", F.when(some, mean).otherwise(0.0).alias("feature"), F.when(some, F.col("peak")).otherwise(0.0).alias("peak"),
                         F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int")))).drop("col")


def logistic(bins: list[tuple], ridge: float = 1e-3) -> tuple[list[float], float]:
    """Slopes and offset of P(1 | x) by Newton's method on (x, ..., ordinary, toxic) counts, with targets drawn in from
    0 and 1 (Platt 1999) and rising slopes: the feature of the most falling slope is left out until none falls."""
    x = np.array([b[:-2] for b in bins], dtype=float).T
    n0, n1 = (np.array([b[k] for b in bins], dtype=float) for k in (-2, -1))
    high, low = (n1.sum() + 1) / (n1.sum() + 2), 1 / (n0.sum() + 2)
    n, y = n0 + n1, n1 * high + n0 * low
    m = np.average(x, axis=1, weights=n)
    s = np.maximum(1e-6, np.sqrt(np.average((x - m[:, None]) ** 2, axis=1, weights=n)))
    used = list(range(len(x)))
    while True:
        z = np.vstack(((x - m[:, None])[used] / s[used, None], np.ones(x.shape[1])))
        b = np.array([1.0] * len(used) + [math.log((n1.sum() + 1) / (n0.sum() + 1))])
        hold = np.array([ridge] * len(used) + [0.0])
        loss = lambda b: float((n * np.logaddexp(0, b @ z) - y * (b @ z)).sum() + hold @ b ** 2)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(b @ z, -35, 35)))
            g = z @ (n * p - y) + 2 * hold * b
            h = (z * (n * p * (1 - p) + 1e-9)) @ z.T + np.diag(2 * hold + 1e-9)
            step, t = np.linalg.solve(h, g), 1.0
            while t > 1e-4 and loss(b - t * step) > loss(b):
                t /= 2
            b = b - t * step
            if np.abs(t * step).max() < 1e-8:
                break
        if not used or b[:-1].min() >= 0:
            break
        used.pop(int(b[:-1].argmin()))
    a = np.zeros(len(x))
    a[used] = b[:-1] / s[used]
    return a.tolist(), float(b[-1] - a @ m)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", learn: Column | None = None,
          model_rows: int = MODEL_ROWS, min_types: int = MIN_TYPES, refit: bool = True) -> DataFrame:
    """(id, score, feature, peak, text_hash) of every document.  ``labels``: (id, toxic 0/1).  ``learn``: a condition on the id column
    for the rows whose labels may be used (default: all).  Without ``refit``, the counts of the folds that the curve's model
    has also give the scores: one pass less over the learning rows."""
    d = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    lab = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias(id_col)).agg(F.max("toxic").cast("int").alias("toxic"))
    if learn is not None:
        lab = lab.where(learn)
    spark, mark = d.sparkSession, C.made()
    lab = C.stored(lab.withColumn("held", F.pmod(F.xxhash64(id_col), F.lit(FOLDS)) == 0), "labels")
    if refit:
        learned = C.stored(C.labelled(d, lab, id_col), "learned", clear=True)   # rows with a label only
    else:
        learned = C.labelled(d, lab.where("not held"), id_col)
    # a model of two folds tells how features of unseen rows bear on the labels; with refit the scores' model counts all folds
    words, other = model(learned.where("not held"), min_types=min_types, slices=SLICES if refit else 1)    # one where the texts are not stored
    words = C.stored(words, "ratios")
    f = C.stored(features(learned.where("held").select("id", "text") if refit else d, words, other, model_rows), "features", clear=True)
    known = learned.where("held").select("id", F.xxhash64("text").alias("t"), "toxic").distinct() if refit else C.bounded(
        lab.where("held").withColumnRenamed(id_col, "id"))
    bins = (f.join(known, ["id", "t"] if refit else ["id"]).groupBy(F.round("feature", 2).alias("x"), F.round("peak", 1).alias("y"))
            .agg(F.count(F.when(F.col("toxic") == 0, 1)).alias("n0"), F.count(F.when(F.col("toxic") == 1, 1)).alias("n1")))
    bins = [tuple(r) for r in bins.collect()]      # bounded: features rounded to 0.01 and 0.1
    if refit:
        C.keep_only(spark, mark, learned)
        words, other = model(learned, min_types=min_types, slices=SLICES)
        words = C.stored(words, "all-ratios")
        C.keep_only(spark, mark, words)
        f = C.stored(features(d, words, other, model_rows), "features", clear=True)
    C.keep_only(spark, mark, f)
    rest = ["feature", "peak", F.col("t").alias("text_hash")]
    if not sum(b[-2] for b in bins) or not sum(b[-1] for b in bins):
        return f.select(F.col("id").alias(id_col), F.lit(0.0).alias("score"), *rest)
    (a, k), c = logistic(bins)
    return f.select(F.col("id").alias(id_col), (1 / (1 + F.exp(-(F.col("feature") * a + F.col("peak") * k + c)))).alias("score"), *rest)
