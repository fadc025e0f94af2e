"""Shared helpers: scratch tables, size-checked broadcasts and NumPy text kernels.

The kernels work on the UTF-8 buffer of an Arrow batch, a bounded number of bytes at a time, so a
task's memory depends on the chunk size and the longest single document, not on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecheck.session import scratch_path

CHUNK_BYTES = 1 << 20      # text bytes a kernel works on at once (one longer document is taken whole)
BROADCAST_ROWS = 500_000   # rows of a few longs that may be broadcast; beyond, the join is shuffled

LONG_WORD = 64             # bytes beyond which a word is not hashed by a polynomial

WORD_REGEX = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NON_LETTER = np.arange(256) < 128   # ASCII but A-Z, a-z; bytes of longer characters count as letters
NON_LETTER[65:91] = NON_LETTER[97:123] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _values(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = _values(11)
_BYTE_LOWER = _BYTE[_LOWER]
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**j and P**-j modulo 2**64 for j < n (kept between calls)."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2))
        for name, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every output bit depends on every input bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix_int(x: int) -> int:
    return int(mix(np.array([x & _MASK], dtype=np.uint64))[0])


def prefix_hash(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[byte] * P**position; ``span_hash`` reads spans from it."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * up[:len(data)], out=out[1:])
    return out


def span_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(pre))
    return (pre[end] - pre[start]) * down[start]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its n + 1 offsets; NULL texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = 0) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (a longer row stands alone)."""
    limit, n, i = limit or CHUNK_BYTES, len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def text_chunks(column: pa.Array, limit: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of each bounded piece of a text column."""
    data, off = utf8(column)
    for i, j in chunks(off, limit):
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]


def word_spans(data: np.ndarray, off: np.ndarray, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word: by default, of bytes other than space and 0x09-0x0D."""
    if not len(data):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    inside = ~outside[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(off, start, side="right") - 1


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = True, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and row of every word, A-Z lower-cased if asked.  Polynomials modulo 2**64 have words of some hundred
    bytes and more that collide whatever the base (Thue-Morse words), so long words are hashed by XXH3."""
    start, end, row = word_spans(data, off, outside)
    pre = prefix_hash(data, _BYTE_LOWER if lower else _BYTE)
    out = mix(span_hash(pre, start, end) + (end - start).astype(np.uint64))
    long_ = np.flatnonzero(end - start > LONG_WORD)
    if len(long_):
        raw = (_LOWER[data] if lower else data).tobytes()
        out[long_] = [xxhash.xxh3_64_intdigest(raw[start[k]:end[k]]) for k in long_]
    return out, row


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-word shingles of each row, sorted by (row, hash).  A row with 1 to n - 1 words
    has its whole sequence as one shingle, a row without words has none."""
    wh, row = word_hashes(data, off)
    rows = len(off) - 1
    if not len(wh):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    count = np.bincount(row, minlength=rows)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    h = np.zeros(len(wh), dtype=np.uint64)
    for k in range(n):
        h[:max(0, len(wh) - k)] += wh[k:] * np.uint64(mix_int(k + 1) | 1)
    keep = np.arange(len(wh)) - first[row] <= count[row] - n
    parts, at = [mix(h[keep])], [row[keep]]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        s = np.zeros(len(short), dtype=np.uint64)
        for k in range(n - 1):
            has = count[short] > k
            s[has] += wh[first[short[has]] + k] * np.uint64(mix_int(k + 101) | 1)
        parts.append(mix(s + count[short].astype(np.uint64)))
        at.append(short)
    h, r = np.concatenate(parts), np.concatenate(at)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[new], r[new]


def longs(x: np.ndarray) -> pa.Array:
    """An int64 Arrow array of the same 64 bits."""
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


# ---------------------------------------------------------------- Spark side

_made: list[str] = []


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, clear: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back: lineage is cut, and a lost
    executor costs a re-read.  ``release`` removes the folders.  With ``clear`` the shuffle files of the write go when it
    ends, not only when the driver happens to collect its garbage."""
    path = scratch_path(df.sparkSession, name)
    before = df.sparkSession.conf.get(CLEANUP, "false")
    df.sparkSession.conf.set(CLEANUP, "true" if clear else before)
    try:
        df.write.parquet(path)
    finally:
        df.sparkSession.conf.set(CLEANUP, before)
    _made.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def drop_stored(spark: SparkSession, mark: int, keep: int = 0) -> None:
    """Remove scratch tables made since ``mark`` (see ``made``), but the last ``keep``.  A collection on the
    driver lets Spark's context cleaner remove the shuffle files of the jobs that wrote them."""
    jvm = spark._jvm
    for path in _made[mark:len(_made) - keep]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    del _made[mark:len(_made) - keep]
    jvm.System.gc()


def keep_only(spark: SparkSession, mark: int, *tables: DataFrame) -> None:
    """Remove the scratch tables made since ``mark`` but these stored ones."""
    kept = [t.scratch for t in tables]
    _made[mark:] = kept + [p for p in _made[mark:] if p not in kept]
    end = mark + len(kept)
    drop_stored(spark, end)


def made() -> int:
    return len(_made)


def release(spark: SparkSession) -> None:
    """Remove every scratch table of this process.  Call it once the results are written."""
    drop_stored(spark, 0)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else ``df`` (shuffled join).
    ``df`` should be stored: it is counted here."""
    n = df.limit(rows + 1).count()
    return F.broadcast(df) if n <= rows else df


def narrowed(df: DataFrame, keys: DataFrame, on: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """All rows of ``df`` whose ``on`` is among ``keys`` and few others: a Bloom filter of at most ``rows`` words of 64 bits
    (16 bits a key, fewer beyond 4 * ``rows`` keys; four of them set in one word) is broadcast.  What it lets pass is to be joined."""
    size = min(max(1, rows), keys.count() // 4 + 1)
    place, draw = F.pmod(F.xxhash64(F.col(on)), F.lit(size)), F.xxhash64(F.col(on), F.lit(1))
    bits = F.lit(0).cast("long")
    for k in range(4):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(draw, 6 * k).bitwiseAND(63).cast("int")))
    words = keys.groupBy(place.alias("filter_place")).agg(F.bit_or(bits).alias("filter_bits"))
    return df.join(F.broadcast(words), place == F.col("filter_place")).where(F.col("filter_bits").bitwiseAND(bits) == bits).select(df.columns)


def labelled(df: DataFrame, keys: DataFrame, on: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` joined with ``keys``, of which few columns and many rows may be: beyond ``rows`` keys the join is shuffled, but only
    the rows of ``df`` that a filter of the keys lets pass.  ``keys`` should be stored: it is counted here."""
    if keys.limit(rows + 1).count() <= rows:
        return df.join(F.broadcast(keys), on)
    return narrowed(df, keys, on, rows).join(keys, on)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
