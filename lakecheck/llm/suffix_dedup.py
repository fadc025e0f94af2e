"""Removal of repeated passages by prefix-free parsing.

A w-gram whose rolling hash is the least among the w-grams of some ``length``-byte string is a trigger.
Consecutive strings that share their least trigger hash form one phrase: the bytes they cover.  The
parse is a function of the bytes around a position only, so equal passages are cut alike, and every
repeated string lies in phrases with the same trigger.

1. Parse: one row per phrase (trigger, content hash, document, place), about 1 per 80 bytes.
2. Dictionary: phrases are grouped by trigger.  A trigger that occurs once has no repeated string.  A
   phrase whose content occurs again repeats as a whole, which settles all its strings for all its
   occurrences: a group of copies is one dictionary entry, however large.
3. Triggers with several different phrases are settled on the bytes of their distinct phrases only.
   A task builds the suffix array of its part of the dictionary, to depth ``length``, by doubling the
   ranks of fixed-length prefixes (8, 16, ... bytes): two strings repeat if their ranks are equal.  An
   entry that occurs more than once counts as repeated by itself.
4. The marked strings of a document are merged into maximal runs and cut out.

Distinct phrases are found by grouping, which combines before the shuffle.  Step 3 deals phrases by their
trigger; the strings of a crowded trigger (more than ``CROWDED`` distinct phrases) are dealt one by one, by
two 64-bit hashes of their bytes, so no task holds more than a bounded number of phrases of one trigger.

Defined cases: NULL and empty texts have 0 bytes and nothing removed; texts shorter than ``length``
keep everything; repeated rows lose everything if they are long enough; rows are told apart by an own key, so an
id may occur twice or be NULL, and each row is cut and kept; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecheck.llm import common as C

GRAM = 40                   # bytes of a trigger
CROWDED = 20_000            # distinct phrases of a trigger that one task settles
_V1, _V2 = C._values(23), C._values(29)


def _sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of each k consecutive values (block prefixes and suffixes)."""
    n = len(x)
    pad = -n % k
    y = np.concatenate((x, np.full(pad + k, x.max(), dtype=x.dtype)))
    blocks = y.reshape(-1, k)
    pre = np.minimum.accumulate(blocks, axis=1).ravel()
    suf = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suf[:n - k + 1], pre[k - 1:n])


def parse(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Phrases of the rows: row, start (first string's position in the row), strings, trigger, content hash
    and whether the trigger occurs more than once in the phrase."""
    n, w = len(data), min(GRAM, length)
    z = np.zeros(0, dtype=np.int64)
    if n < length:
        return z, z, z, z.view(np.uint64), z.view(np.uint64), z.astype(bool)
    pre = C.prefix_hash(data, _V1)
    at = np.arange(n - w + 1)
    gram = C.mix(C.span_hash(pre, at, at + w))
    k = length - w + 1
    bits = np.uint64(max(1, int(n).bit_length()))
    high = (gram >> bits) << bits
    first = _sliding_min(high | at.astype(np.uint64), k)
    last = _sliding_min(high | (np.uint64(n) - at.astype(np.uint64)), k)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    where = (first & mask).astype(np.int64)
    back = n - (last & mask).astype(np.int64)
    least = first >> bits
    valid = np.ones(n - length + 1, dtype=bool)             # strings inside one row
    for o in off[1:-1]:
        valid[max(0, o - length + 1):o] = False
    row_start = np.zeros(len(valid), dtype=bool)
    row_start[off[:-1][off[:-1] < len(valid)]] = True
    cut = np.ones(len(valid), dtype=bool)
    cut[1:] = (least[1:] != least[:-1]) | ~valid[:-1] | row_start[1:]
    begin = np.flatnonzero(cut & valid)
    stop = np.flatnonzero(valid & np.concatenate((cut[1:] | ~valid[1:], [True]))) + 1
    row = np.searchsorted(off, begin, side="right") - 1
    again = np.minimum.reduceat(where, begin) != 0 if len(begin) else z.astype(bool)
    if len(begin):
        ends = np.stack((begin, np.minimum(stop, len(valid))), axis=1).ravel()
        grow = lambda f, x: f.reduceat(np.append(x, x[-1]), ends)[::2]
        again = grow(np.minimum, where) != grow(np.maximum, back)
    pre2 = C.prefix_hash(data, _V2)
    content = C.mix(C.span_hash(pre2, begin, stop + length - 1) + (stop - begin).astype(np.uint64))
    return row, begin - off[row], stop - begin, gram[where[begin]], content, again


def _phrases(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, off in C.text_chunks(b.column(1)):
                row, start, n, trigger, content, again = parse(data, off, length)
                yield pa.RecordBatch.from_arrays(
                    [C.longs(ids[i:j][row]), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
                     C.longs(trigger), C.longs(content), pa.array(again)], ["id", "start", "n", "trigger", "content", "again"])
    return run


def _bytes(length: int):
    """(id, text, places) -> one row per place with its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = C.utf8(b.column(1))
            raw, out, size = data.tobytes(), [[] for _ in range(6)], 0
            for x, (i, places) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist())):
                for p in places:
                    s = int(off[x]) + p["start"]
                    piece = raw[s:s + p["n"] + length - 1]
                    for c, v in zip(out, (i, p["start"], p["n"], p["trigger"], p["many"], piece)):
                        c.append(v)
                    size += len(piece)
                    if size > 4 * C.CHUNK_BYTES:
                        yield pa.RecordBatch.from_arrays(_columns(out), _NAMES)
                        out, size = [[] for _ in range(6)], 0
            yield pa.RecordBatch.from_arrays(_columns(out), _NAMES)
    return run


_NAMES = ["id", "start", "n", "trigger", "many", "piece"]


def _columns(out):
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
    return [pa.array(c, t) for c, t in zip(out, kinds)]


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length``-byte prefix of every suffix of ``data`` that is so long: the suffix array's order to
    that depth, equal prefixes with equal ranks (prefix doubling)."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    depth = min(8, length)
    key = np.zeros(len(data) - depth + 1, dtype=np.uint64)
    for k in range(depth):
        key = (key << np.uint64(8)) | data[k:k + len(key)].astype(np.uint64)
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    while depth < length:
        step = min(depth, length - depth)
        m = len(rank) - step
        rank = np.unique((rank[:m] << np.int64(32)) | rank[step:], return_inverse=True)[1].astype(np.int64)
        depth += step
    return rank[:n]


def _repeated(length: int):
    """Rows sorted by trigger -> (id, start, n) runs of repeated strings of the phrases that occur once.  Triggers are
    taken together until a bounded number of bytes is reached."""
    def settle(rows: list) -> pa.RecordBatch:
        pieces = [r[5] for r in rows]
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        off = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
        n = np.array([r[2] for r in rows])
        rank = suffix_ranks(data, length)
        pos = np.repeat(off[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        of = np.repeat(np.arange(len(rows)), n)
        trigger = np.unique(np.array([r[3] for r in rows]), return_inverse=True)[1][of]
        key = np.unique((trigger.astype(np.int64) << np.int64(32)) | rank[pos], return_inverse=True)[1]
        weight = np.bincount(key, weights=np.where([r[4] for r in rows], 2, 1)[of])
        hit = (weight[key] >= 2) & ~np.array([r[4] for r in rows])[of]
        at = pos - off[of]
        edge = np.diff(np.concatenate(([0], (hit).astype(np.int8), [0])))
        same = np.concatenate(([True], of[1:] != of[:-1]))
        begin = np.flatnonzero(hit & (same | (edge[:-1] == 1)))
        stop = np.flatnonzero(hit & np.concatenate((same[1:], [True]) if len(hit) else []).astype(bool) | (edge[1:] == -1)) + 1
        r = of[begin]
        ids, starts = np.array([x[0] for x in rows], dtype=np.int64), np.array([x[1] for x in rows], dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ids[r]), pa.array(starts[r] + at[begin]), pa.array((stop - begin).astype(np.int64))],
                                          ["id", "start", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns]):
                if r[3] != last and size > 2 * C.CHUNK_BYTES:
                    yield settle(held)
                    held, size = [], 0
                last = r[3]
                held.append(r)
                size += len(r[5])
        if held:
            yield settle(held)
    return run


def _strings(length: int):
    """Phrases -> one row per string: two hashes, id, start and whether the phrase is known to repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, starts = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            many = b.column(4).to_numpy(zero_copy_only=False)
            for i, j, data, off in C.text_chunks(b.column(5)):
                n = np.diff(off) - length + 1
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                of = np.repeat(np.arange(j - i), n)
                s = off[:-1][of] + at
                h = [C.mix(C.span_hash(C.prefix_hash(data, v), s, s + length)) for v in (_V1, _V2)]
                yield pa.RecordBatch.from_arrays([C.longs(h[0]), C.longs(h[1]), pa.array(ids[i:j][of]), pa.array(starts[i:j][of] + at),
                                                  pa.array(many[i:j][of].astype(bool))], ["h1", "h2", "id", "start", "many"])
    return run


def _cut(length: int):
    """(id, text, runs) -> digest and kept text of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = C.utf8(b.column(1))
            raw, out = data.tobytes(), [[] for _ in range(6)]
            for x, (i, runs) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist())):
                text = raw[int(off[x]):int(off[x + 1])]
                spans = merge(((r["start"], r["start"] + r["n"] + length - 1) for r in runs or ()))
                kept, last = [], 0
                for s, e in spans:
                    kept.append(text[last:s])
                    last = e
                kept = b"".join([*kept, text[last:]])
                for c, v in zip(out, (i, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                                      kept.decode("utf-8", "ignore"))):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            more = b.columns[3:]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(out, kinds)], *more], [*CUT, *b.schema.names[3:]])
    return run


CUT = ("id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")


def merge(spans) -> list[tuple[int, int]]:
    """Maximal runs of the covered bytes."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def repeated_runs(docs: DataFrame, length: int = 200, crowded: int = CROWDED) -> DataFrame:
    """(id, start, n): runs of n start positions whose ``length``-byte string starts anywhere else too."""
    d, mark = docs.select("id", "text"), C.made()
    p = C.stored(d.mapInArrow(_phrases(length), "id long, start int, n int, trigger long, content long, again boolean"), "parse")
    # dictionary entries: one row per distinct phrase; a trigger matters if it occurs twice
    entry = p.groupBy("trigger", "content").agg(F.count("*").alias("k"), F.max("again").alias("again"))
    trig = entry.groupBy("trigger").agg(F.sum("k").alias("k"), F.count("*").alias("entries"), F.max("again").alias("again"))
    live = C.stored(trig.where("k > 1 or again").select("trigger", F.when(F.col("entries") > crowded, 2).when((F.col("entries") > 1) | F.col("again"), 1)
                                                     .otherwise(0).alias("differ")), "triggers")
    hits = C.stored(p.drop("again").join(live, "trigger"), "live")
    C.keep_only(docs.sparkSession, mark, hits)
    first = hits.groupBy("trigger", "content").agg(F.count("*").alias("k"), F.min(F.struct("id", "start", "n")).alias("f"), F.first("differ").alias("differ"))
    first = C.stored(first.select("trigger", "content", (F.col("k") > 1).alias("many"), "f", "differ"), "dictionary")
    many = hits.join(first.where("many").select("trigger", "content"), ["trigger", "content"], "left_semi")
    whole = many.select("id", F.col("start").cast("long").alias("start"), F.col("n").cast("long").alias("n"))
    want = C.stored(first.where("differ > 0").select("f.id", "differ", F.struct("f.start", "f.n", "trigger", "many").alias("p"))
                    .groupBy("id", "differ").agg(F.collect_list("p").alias("places")), "places")

    def pieces_of(kind: int) -> DataFrame:
        return d.join(want.where(f"differ = {kind}"), "id").select("id", "text", "places").mapInArrow(
            _bytes(length), "id long, start int, n int, trigger long, many boolean, piece binary")

    if want.where("differ = 2").limit(1).count():
        s = pieces_of(2).select(*_NAMES).mapInArrow(_strings(length), "h1 long, h2 long, id long, start long, many boolean")
        s = C.stored(s, "strings")
        twice = s.groupBy("h1", "h2").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("k")).where("k > 1").select("h1", "h2")
        whole = whole.union(s.where("not many").join(twice, ["h1", "h2"], "left_semi").select("id", "start", F.lit(1).cast("long").alias("n")))
    pieces = pieces_of(1)
    pieces = pieces.repartition(C.partitions(pieces), "trigger").sortWithinPartitions("trigger")
    part = pieces.select(*_NAMES).mapInArrow(_repeated(length), "id long, start long, n long")
    return whole.union(part)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, crowded: int = CROWDED,
                carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept_text) of every document, and the columns to ``carry``.
    ``kept_text`` drops the bytes of a character that a cut divides; the digest is of the remaining bytes."""
    extra = [F.col(c).alias(f"__c{k}") for k, c in enumerate(carry)]
    d = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("text"), *extra)
    mark = C.made()
    d = C.stored(d.withColumn("id", F.monotonically_increasing_id()), "rows")       # written once: a retried task reads the same keys
    runs = C.stored(repeated_runs(d, length, crowded).groupBy("id").agg(F.collect_list(F.struct("start", "n")).alias("runs")), "runs")
    C.keep_only(docs.sparkSession, mark, d, runs)
    names = ["__id", *[f"__c{k}" for k in range(len(carry))]]
    out = d.join(runs, "id", "left").select("id", "text", "runs", *names)
    kinds = ", __id long" + "".join(f", __c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(carry))
    out = out.mapInArrow(_cut(length), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string" + kinds)
    clash = {id_col, *CUT[1:]}
    return out.select(F.col("__id").alias(id_col), *CUT[1:], *[F.col(f"__c{k}").alias(c) for k, c in enumerate(carry) if c not in clash])
