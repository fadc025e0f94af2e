"""Language identification with language-bitmask n-gram filters.

Training texts give each language's byte 4-grams (letters lower-cased, other ASCII bytes a space).  An
n-gram belongs to every language where its rate is at least ``SHARE`` of its highest rate, however seldom it is.  A bit-sliced
Bloom filter keeps a mask of language bits per slot, in words of 63 bits: the AND of an n-gram's ``HASHES`` slots returns
all languages containing it at once.  A document is decided by the per-language popcounts over its n-grams, each
corrected for the filter's false positives of that language; the score is the winner's part of their sum.

The filter has a fixed number of slots (a parameter), so what is sent to the executors has a proven bound;
n-gram counts are combined per batch before the shuffle.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0; a text whose n-grams are all
unknown gets the language with most training text, score 0; NULL languages and texts teach nothing; with
no training rows all is ``und``; rows with NULL or repeated ids are judged one by one, and NULL ids are not held out;
other columns are ignored.  Any number of languages; the filter has a word a slot for every 63.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecheck.llm import common as C

SLOTS = 1 << 22
HASHES = 3
SHARE = 0.2
WORD = 63            # language bits of a mask word
UNKNOWN = "und"
COUNT_BYTES = 8 << 20
_BLANK = np.uint32(0x20202020)
_FOLD = np.where(C.NON_LETTER, 0x20, C._LOWER).astype(np.uint8)


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code (four bytes) and row of every 4-gram inside a row that has a letter."""
    low = _FOLD[data]
    if len(low) > 1:                     # capitals of the Latin-1 letters (U+00C0-U+00DE)
        up = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low[1:][up] += 0x20
    # a space on either side of each row, so that words at its ends look like others
    n = np.diff(off)
    wide = np.full(len(low) + 2 * len(n), 0x20, dtype=np.uint8)
    at = np.arange(len(low)) + 2 * np.repeat(np.arange(len(n)), n) + 1
    wide[at] = low
    if len(wide) < 4:
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
    x = wide.astype(np.uint32)
    code = (x[:-3] << np.uint32(24)) | (x[1:-2] << np.uint32(16)) | (x[2:-1] << np.uint32(8)) | x[3:]
    ends = np.cumsum(n + 2)
    row = np.repeat(np.arange(len(n)), n + 2)[:len(code)]
    ok = (np.arange(len(code)) + 4 <= ends[row]) & (code != _BLANK)
    return code[ok], row[ok]


def slots(code: np.ndarray, k: int, size: int) -> np.ndarray:
    return (C.mix(code.astype(np.uint64) + np.uint64((k + 1) << 40)) % np.uint64(size)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) -> (lang, code, n), combined over some texts."""
    def flush(held, names):
        key, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(names).take(pa.array((key >> np.uint64(32)).astype(np.int64))),
                                           pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], ["lang", "code", "n"])
    for b in batches:
        d = b.column(1).dictionary_encode()
        lang, names, held, size = d.indices.to_numpy(zero_copy_only=False).astype(np.uint64), d.dictionary.to_pylist(), [], 0
        for i, j, data, off in C.text_chunks(b.column(0)):
            code, row = grams(data, off)
            held.append((lang[i:j][row] << np.uint64(32)) | code)
            size += len(data)
            if size > COUNT_BYTES:
                yield flush(held, names)
                held, size = [], 0
        if held:
            yield flush(held, names)


def _masks(size: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = b.column(0).to_numpy(zero_copy_only=False)
            for k in range(hashes):
                yield pa.RecordBatch.from_arrays([pa.array(slots(code.astype(np.uint64), k, size)), b.column(1), b.column(2)], ["slot", "mask", "word"])
    return run


def fit(train: DataFrame, size: int = SLOTS, hashes: int = HASHES, share: float = SHARE) -> tuple[list[str], np.ndarray]:
    """Languages and the filter's slots, from (text, lang) rows."""
    n = train.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(
        _counts, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    n = C.stored(n, "gram-counts")
    totals = {r["lang"]: r["t"] for r in n.groupBy("lang").agg(F.sum("n").alias("t")).collect()}      # one row a language
    langs = sorted(totals, key=lambda x: (-totals[x], x))
    if not langs:
        return [], np.zeros((1, size), dtype=np.uint8)
    known = train.sparkSession.createDataFrame([(x, float(totals[x]), i // WORD, 1 << i % WORD) for i, x in enumerate(langs)],
                                               "lang string, total double, word int, bit long")
    rows = n.join(F.broadcast(known), "lang").select("code", (F.col("n") / F.col("total")).alias("r"), "word", "bit")
    top = rows.groupBy("code").agg(F.max("r").alias("top"))
    masks = rows.join(top, "code").where(F.col("r") >= F.col("top") * share).groupBy("code", "word").agg(F.bit_or("bit").alias("mask"))
    t = masks.select("code", "mask", "word").mapInArrow(_masks(size, hashes), "slot long, mask long, word int").groupBy("word", "slot").agg(
        F.bit_or("mask").alias("mask")).toArrow()                                   # at most size rows a word
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if min(len(langs), WORD) <= np.dtype(k).itemsize * 8)
    table = np.zeros((-(-len(langs) // WORD), size), dtype=kind)
    table[t.column("word").to_numpy(), t.column("slot").to_numpy()] = t.column("mask").to_numpy().astype(kind)
    return langs, table


def languages_of(code: np.ndarray, table: np.ndarray, hashes: int) -> np.ndarray:
    """(words, n-grams): the mask of all languages that contain each n-gram, false positives included."""
    mask = np.full((len(table), len(code)), np.iinfo(table.dtype).max, dtype=table.dtype)
    for k in range(hashes):
        mask &= table[:, slots(code, k, table.shape[1])]
    return mask


def has(words: np.ndarray, x: int) -> np.ndarray:
    """The bit of language ``x`` in masks (words, ...)."""
    return (words[x // WORD] >> np.array(x % WORD, dtype=words.dtype)) & 1 == 1


def corrected(hits: np.ndarray, total: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """(languages, documents): popcounts less what the filter's false positives of each language add to them."""
    return np.maximum(0.0, (hits - total * fp[:, None]) / (1 - np.minimum(fp[:, None], 0.99)))


def _judge(langs: list[str], table: np.ndarray, hashes: int):
    fp = np.array([float(has(table, i).mean()) ** hashes for i in range(len(langs))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in C.text_chunks(b.column(1)):
                rows = j - i
                code, row = grams(data, off)
                mask = languages_of(code, table, hashes)
                total = np.bincount(row, minlength=rows)
                hits = np.stack([np.bincount(row[has(mask, x)], minlength=rows) for x in range(len(langs))]) if langs else np.zeros((1, rows))
                right = corrected(hits, total, fp) if langs else hits
                best, whole = right.argmax(axis=0), right.sum(axis=0)
                score = np.where(whole > 0, right.max(axis=0) / np.maximum(whole, 1e-9), 0.0)
                letter = np.bincount(np.repeat(np.arange(rows), np.diff(off)), weights=(data < 128) & ~C.NON_LETTER[data], minlength=rows) > 0
                for x in np.flatnonzero(~letter & (np.diff(off) > 0)):   # only longer characters: is one a letter?
                    letter[x] = any(c.isalpha() for c in data[off[x]:off[x + 1]].tobytes().decode("utf-8", "replace"))
                known = letter & bool(langs)
                names = np.where(known, np.array(langs or [UNKNOWN], dtype=object)[best], UNKNOWN)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, rows), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))],
                                                 ["id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SLOTS, hashes: int = HASHES,
             share: float = SHARE) -> DataFrame:
    """(id, lang_pred, score) of every document, learned from the (text, lang) rows of ``train``."""
    langs, table = fit(train, size, hashes, share)
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(_judge(langs, table, hashes), "id long, lang_pred string, score double").withColumnRenamed("id", id_col)


def held_out(id_col: Column, k: int, r: int) -> Column:
    """Whether the crc32 of the id as text leaves the remainder; not so for NULL."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % k == r, F.lit(False))
