"""N-gram Jaccard join by universe partitioning (pigeonhole with one-deletion neighbourhoods).

Documents are sets of word-shingle hashes.  Set sizes fall into bands so that a partner of at least
the threshold lies in the same band or the next.  Two sets of one band pair differ in at most H
tokens, so with the token universe hashed into H + 1 segments at least one segment's subset is equal
(pigeonhole).  Every document indexes the subset of each segment under its own band and the one
below: sets that meet under a key are candidates and are verified exactly on their texts.

Cost-based allocation: a subset that costs too much - an empty or (in schemes of many segments) a one-token one -
is skipped.  A document that skips k segments allots one-deletion neighbourhoods (the subset itself and it less one
token) to the shortest prefix of segments that has k positions without a skipped subset.  Of two linked sets that
share e skipped subsets and no other, at most e - 1 of the other segments differ in two tokens or more, so one of
these k >= e positions differs in one token and both sets emit the same neighbourhood key.

The exact rest: a key shared by more than ``max_classes`` unlinked classes is crowded, as where a common passage fills
whole segments, and is not compared; its documents, and documents without enough positions for their neighbourhoods,
are.  They index their rarest tokens one by one: in an order common to all sets, with the tokens that many of the rest
share last, two linked sets meet in the first |A| - ceil(threshold |A|) + 1 tokens of each.  Under these keys there
is no limit of classes.  A passage that many unlike documents share so costs nothing, for its tokens come last.

Sets that meet under a key become a candidate row only if their sizes allow a link and a parity sketch does:
with the tokens hashed into buckets, the sets differ in at least one token for every bucket whose counts differ
in parity, and may not differ in more than H.  The test is part of the join condition, so pairs that fail it are
never rows.  Before texts are fetched, a count sketch does the same with the sum of the count differences.

Equal sets are one representative.  Under a key only the smallest id is a pivot; further pairs are
made only between classes that stay unlinked, so a group of copies never yields all its pairs.

Defined cases: NULL and word-less texts have an empty set and link with nothing; fewer words than a
shingle make the whole sequence one shingle; documents repeated with equal text are linked; rows with
a NULL id are dropped; of a repeated id every text counts and the id appears once with its largest
set; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecheck.llm import common as C
from lakecheck.llm.components import components

MAX_CLASSES = 32      # unlinked classes under one key before the key counts as too costly
FEW_SEGMENTS = 4      # schemes of more segments also skip one-token subsets
NEAR = 0              # kinds of emitted rows: a match key,
UNALLOTTED = 1        # a document whose neighbourhoods do not suffice
COMMON = 200_000      # at most so many tokens of the rest are ordered by frequency (a few MB); it only bears on the cost
BUCKETS = 128         # buckets of the count sketch
CHUNK_BYTES = 1 << 19  # text bytes a task works on at once (one longer document is taken whole)
VERIFY_ROWS = 256     # pairs whose texts a task copies at once
WORDS = 8             # 64-bit words of the parity sketch
PARITY = [f"p{k}" for k in range(WORDS)]


@dataclass(frozen=True)
class Spec:
    """Shingle length and the threshold num / den of the Jaccard similarity."""
    words: int = 5
    num: int = 80
    den: int = 100

    def bands(self, largest: int) -> np.ndarray:
        """Upper ends of the size bands, up to the one that holds ``largest``."""
        ends, low = [], 1
        while not ends or ends[-1] < largest:
            ends.append(low * self.den // self.num)
            low = ends[-1] + 1
        return np.array(ends, dtype=np.int64)

    def segments(self, end: np.ndarray) -> np.ndarray:
        """H + 1 for the pairs whose smaller set is in the band with this upper end."""
        return (end + end * self.den // self.num) * (self.den - self.num) // (self.den + self.num) + 1


def _emit(h: np.ndarray, r: np.ndarray, rows: int, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, kind) of the sets (h, r): keys of subsets and neighbourhoods, and the rows they do not suffice for."""
    size = np.bincount(r, minlength=rows)
    ends = spec.bands(max(1, int(size.max(initial=1))))
    own = np.searchsorted(ends, np.maximum(size, 1))
    out: list[tuple[np.ndarray, np.ndarray, int]] = []
    for lower in (0, 1):
        band = own - lower
        use = (size > 0) & (band >= 0)
        if lower:
            use &= size <= ends[band] * spec.den // spec.num
        if not use.any():
            continue
        m = np.where(use, spec.segments(ends[band]), 0)
        base = np.concatenate(([0], np.cumsum(m)))
        of = np.repeat(np.arange(rows), m)                       # row of each segment
        index = np.arange(base[-1]) - base[of]
        take = use[r]
        tr, th = r[take], h[take]
        slot = base[tr] + (C.mix(th ^ np.uint64(0x5851F42D4C957F2D)) % m[tr].astype(np.uint64)).astype(np.int64)
        content = np.zeros(base[-1], dtype=np.uint64)
        np.add.at(content, slot, th)
        n = np.bincount(slot, minlength=base[-1])
        salt = C.mix((band[of].astype(np.uint64) << np.uint64(32)) + index.astype(np.uint64) + np.uint64(1))
        key = C.mix(content + salt + n.astype(np.uint64))
        least = np.where(m > FEW_SEGMENTS, 2, 1)[of]             # smaller subsets are too common
        skipped = n < least
        out.append((of[~skipped], key[~skipped], NEAR))
        need = np.bincount(of[skipped], minlength=rows)
        good = np.cumsum((~skipped & (n > least)).astype(np.int64))
        seen = np.concatenate(([0], good))
        good = good - seen[base[of]]                             # good positions of the row up to here
        before = good - (~skipped & (n > least))
        near = (need[of] > 0) & (before < need[of])              # the shortest sufficient prefix
        last = np.zeros(rows, dtype=np.int64)
        np.maximum.at(last, of, good)
        poor = np.flatnonzero(last < need)
        out.append((poor, np.zeros(len(poor), dtype=np.uint64), UNALLOTTED))
        away = C.mix(salt + np.uint64(0xD6E8FEB86659FD93))
        full = near & (n >= least)
        out.append((of[full], C.mix(content[full] + away[full] + n[full].astype(np.uint64)), NEAR))
        less = near[slot] & (n[slot] > least[slot])
        s = slot[less]
        out.append((of[s], C.mix(content[s] - th[less] + away[s] + (n[s] - 1).astype(np.uint64)), NEAR))
    if not out:
        z = np.zeros(0, dtype=np.int64)
        return z, z.view(np.uint64), z
    return (np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out]),
            np.concatenate([np.full(len(x[0]), x[2]) for x in out]))


def _keys(spec: Spec):
    """mapInArrow function: (id, text) -> (key, id, kind)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, off in C.text_chunks(b.column(1), CHUNK_BYTES):
                row, key, kind = _emit(*C.shingle_sets(data, off, spec.words), j - i, spec)
                own = kind == UNALLOTTED                      # a key of their own, so that many do not meet in one task
                key[own] = C.mix(ids[i:j][row[own]].astype(np.uint64))
                yield pa.RecordBatch.from_arrays([C.longs(key), C.longs(ids[i:j][row]), pa.array(kind.astype(np.int8))],
                                                 ["key", "id", "kind"])
    return run


def _tokens(spec: Spec):
    """mapInArrow function: (id, text) -> the tokens of each set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, off in C.text_chunks(b.column(1), CHUNK_BYTES):
                yield pa.RecordBatch.from_arrays([C.longs(C.shingle_sets(data, off, spec.words)[0])], ["token"])
    return run


def _rarest(spec: Spec, common: np.ndarray):
    """mapInArrow function: (id, text) -> (key, id, kind) of the first tokens of each set, in the order: tokens that
    are not in ``common`` by hash, then those of ``common`` from its end."""
    at = np.argsort(common)
    known = common[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, off in C.text_chunks(b.column(1), CHUNK_BYTES):
                h, r = C.shingle_sets(data, off, spec.words)
                late = np.zeros(len(h), dtype=np.int64)
                if len(known):
                    k = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    late = np.where(known[k] == h, len(known) - at[k], 0)
                o = np.lexsort((h, late, r))
                h, r = h[o], r[o]
                size = np.bincount(r, minlength=j - i)
                first = np.cumsum(size) - size
                most = size - (size * spec.num + spec.den - 1) // spec.den + 1
                take = np.arange(len(h)) - first[r] < most[r]
                yield pa.RecordBatch.from_arrays([C.longs(h[take]), C.longs(ids[i:j][r[take]]), pa.array(np.full(int(take.sum()), NEAR, dtype=np.int8))],
                                                 ["key", "id", "kind"])
    return run


def _sets(spec: Spec):
    """mapInArrow function: (id, text) -> (id, n, s1, s2, sketch, p0...): size, two commutative hashes, count and parity sketch of the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, off in C.text_chunks(b.column(1), CHUNK_BYTES):
                h, r = C.shingle_sets(data, off, spec.words)
                s = [np.zeros(j - i, dtype=np.uint64) for _ in range(2)]
                np.add.at(s[0], r, h)
                np.add.at(s[1], r, C.mix(h ^ np.uint64(0xA0761D6478BD642F)))
                slot = r * BUCKETS + (C.mix(h + np.uint64(7)) % np.uint64(BUCKETS)).astype(np.int64)
                sketch = np.minimum(np.bincount(slot, minlength=(j - i) * BUCKETS), 255).astype(np.uint8).reshape(-1, BUCKETS)
                slot = r * (64 * WORDS) + (C.mix(h + np.uint64(13)) % np.uint64(64 * WORDS)).astype(np.int64)
                odd = (np.bincount(slot, minlength=(j - i) * 64 * WORDS) & 1).astype(np.uint8)
                bits = np.packbits(odd).view(np.int64).reshape(-1, WORDS)
                yield pa.RecordBatch.from_arrays([C.longs(ids[i:j]), C.longs(np.bincount(r, minlength=j - i)), C.longs(s[0]), C.longs(s[1]),
                                                  pa.array([x.tobytes() for x in sketch], pa.binary()), *(C.longs(bits[:, k]) for k in range(WORDS))],
                                                 ["id", "n", "s1", "s2", "sketch", *PARITY])
    return run


def _near(spec: Spec):
    """mapInArrow function: (a, b, size a, size b, sketch a, sketch b) -> the pairs that may reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3)]
            x, y = (np.frombuffer(C.utf8(b.column(k))[0], dtype=np.uint8).reshape(-1, BUCKETS).astype(np.int16) for k in (4, 5))
            most = (n[0] + n[1]) * (spec.den - spec.num) // (spec.den + spec.num)
            ok = (np.minimum(*n) * spec.den >= np.maximum(*n) * spec.num) & (np.abs(x - y).sum(axis=1, dtype=np.int64) <= most)
            yield pa.RecordBatch.from_arrays([b.column(k).filter(pa.array(ok)) for k in (0, 1)], ["a", "b"])
    return run


def _verify(spec: Spec):
    """mapInArrow function: (a, b, text a, text b) -> (a, b) of the pairs that reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(k, VERIFY_ROWS) for whole in batches for k in range(0, whole.num_rows, VERIFY_ROWS)):
            ids = [b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
            data, off = C.utf8(pa.concat_arrays([b.column(2), b.column(3)]))
            n, i = b.num_rows, 0
            while i < n:
                j = i + 1
                while j < n and off[j + 1] - off[i] + off[n + j + 1] - off[n + i] <= 2 * CHUNK_BYTES:
                    j += 1
                side = [C.shingle_sets(data[off[k + i]:off[k + j]], off[k + i:k + j + 1] - off[k + i], spec.words) for k in (0, n)]
                size = [np.bincount(r, minlength=j - i) for _, r in side]
                h, r = np.concatenate([side[0][0], side[1][0]]), np.concatenate([side[0][1], side[1][1]])
                o = np.lexsort((h, r))
                h, r = h[o], r[o]
                both = np.bincount(r[1:][(h[1:] == h[:-1]) & (r[1:] == r[:-1])], minlength=j - i)
                ok = (both > 0) & (spec.den * both >= spec.num * (size[0] + size[1] - both))
                yield pa.RecordBatch.from_arrays([C.longs(ids[0][i:j][ok]), C.longs(ids[1][i:j][ok])], ["a", "b"])
                i = j
    return run


class _Join:
    def __init__(self, docs: DataFrame, sets: DataFrame, spec: Spec, max_classes: int):
        self.docs, self.sets, self.spec, self.max_classes = docs, sets, spec, max_classes
        self.spark = docs.sparkSession

    def emit(self, docs: DataFrame) -> DataFrame:
        return docs.select("id", "text").mapInArrow(_keys(self.spec), "key long, id long, kind byte")

    def rarest(self, docs: DataFrame, common: np.ndarray) -> DataFrame:
        return docs.select("id", "text").mapInArrow(_rarest(self.spec, common), "key long, id long, kind byte")

    def common(self, docs: DataFrame) -> np.ndarray:
        """The tokens that most of ``docs`` share, the most common first; at most ``COMMON``."""
        n = (docs.select("id", "text").mapInArrow(_tokens(self.spec), "token long").groupBy("token").agg(F.count("*").alias("n"))
             .where(F.col("n") > self.max_classes).orderBy(F.desc("n"), "token").limit(COMMON))
        return np.array([r[0] for r in n.select("token").collect()], dtype=np.int64).view(np.uint64)

    def groups(self, rows: DataFrame, name: str) -> DataFrame:
        """(key, id, pivot) of the ids that are not the first of their key, and (NULL, id, NULL) of unallotted ones."""
        near = (rows.repartition(C.partitions(rows), "key", "kind").withColumn("pivot", F.min("id").over(
            Window.partitionBy("key", "kind").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow))))
        return C.stored(near.where(f"kind = {UNALLOTTED} or pivot <> id").select(
            F.when(F.col("kind") == NEAR, F.col("key")).alias("key"), "id",
            F.when(F.col("kind") == NEAR, F.col("pivot")).alias("pivot")).distinct(), name)

    def tested(self, rows: DataFrame, id_col: str = "id") -> DataFrame:
        """``rows`` with the size and the parity sketch of their set; a repeated id has a row for each of its texts."""
        return rows.join(self.sets.select(F.col("id").alias(id_col), "n", *PARITY), id_col)

    def may_link(self, x: str, y: str) -> Column:
        """Whether the sizes and parity sketches of the rows aliased ``x`` and ``y`` allow a link."""
        a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
        differ = sum((F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in PARITY), F.lit(0))
        return ((F.least(a, b) * self.spec.den >= F.greatest(a, b) * self.spec.num)
                & (differ * (self.spec.den + self.spec.num) <= (a + b) * (self.spec.den - self.spec.num)))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The linked ones of the candidate pairs (a, b); texts of candidates only are moved."""
        sets = self.sets.select("id", "n", "sketch")
        side = [sets.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"s{k}")) for k in "ab"]
        near = pairs.select("a", "b").distinct().join(side[0], "a").join(side[1], "b").select("a", "b", "na", "nb", "sa", "sb")
        pairs = C.stored(near.mapInArrow(_near(self.spec), "a long, b long").distinct(), "candidates")
        ids = C.stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "candidate-ids")
        t = self.docs.join(C.bounded(ids), "id", "left_semi")
        one = pairs.join(t.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        two = one.join(t.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        return C.stored(two.select("a", "b", "ta", "tb").mapInArrow(_verify(self.spec), "a long, b long"), "links")

    def across(self, groups: DataFrame, links: DataFrame, most: int | None) -> tuple[DataFrame, DataFrame | None]:
        """The pairs of different classes under keys of at most ``most`` classes, and the ids under the other keys."""
        comp = C.stored(components(links), "classes")
        g = groups.where("key is not null")
        member = g.select("key", "id").union(g.select("key", F.col("pivot").alias("id")).distinct())
        member = (member.join(comp.withColumnRenamed("node", "id"), "id", "left")
                  .select("key", "id", F.coalesce("root", "id").alias("c")))
        # one row per class and key; then the classes of a key, kept only where there are two to max_classes
        n = member.select("key", "c").distinct().groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        n = C.stored(n, "key-classes")
        few = n if most is None else n.where(f"n <= {most}")
        open_ = C.stored(self.tested(member.join(few.select("key"), "key")), "open")
        x, y = open_.alias("x"), open_.alias("y")
        pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.c") < F.col("y.c")) & self.may_link("x", "y")).select(
            F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
        crowded = None if most is None else member.join(n.where(f"n > {most}").select("key"), "key", "left_semi").select("id").distinct()
        return pairs, crowded

    def round(self, rows: DataFrame, name: str, most: int | None, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame]:
        """Verification of the sets that meet under the keys of ``rows``: (all links so far, ids under crowded keys, unallotted ids), stored."""
        g = self.groups(rows, name)
        links = self.verified(g.where("key is not null").select(F.col("pivot").alias("a"), F.col("id").alias("b")))
        links = links if known is None else C.stored(known.union(links), "links-so-far")
        pairs, crowded = self.across(g, links, most)
        crowded = crowded if crowded is None else C.stored(crowded, "crowded")
        links = C.stored(links.union(self.verified(pairs)), "links-of-round")
        return links, crowded, C.stored(g.where("key is null").select("id").distinct(), "unallotted")

    def links(self, reps: DataFrame) -> DataFrame:
        """Links between the representatives ``reps`` that give the same components as all links."""
        mark = C.made()
        links, crowded, poor = self.round(self.emit(reps), "groups", self.max_classes)
        C.keep_only(self.spark, mark, links, crowded, poor)
        rest = C.stored(crowded.union(poor).distinct(), "rest")
        if not rest.limit(1).count():
            return links
        docs = self.docs.join(C.bounded(rest), "id", "left_semi")
        common = self.common(docs)
        rows = self.rarest(docs, common)
        if poor.limit(1).count():                  # these can also have links to documents outside the rest
            keys = C.stored(self.rarest(self.docs.join(C.bounded(poor), "id", "left_semi"), common).select("key").distinct(), "poor-keys")
            others = reps.join(C.bounded(rest), "id", "left_anti")
            rows = rows.union(self.rarest(others, common).join(C.bounded(keys), "key", "left_semi"))
        return self.round(rows, "rarest", None, links)[0]


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80,
                    den: int = 100, max_classes: int = MAX_CLASSES) -> DataFrame:
    """(id, n_shingles, component_id): the classes of documents reachable by links, where two documents
    link if den * |A & B| >= num * |A | B| over their distinct ``words``-word shingles."""
    spec = Spec(words, num, den)
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    base = C.stored(d.mapInArrow(_sets(spec), "id long, n long, s1 long, s2 long, sketch binary, " + ", ".join(f"{p} long" for p in PARITY)), "sets")
    full = base.where("n > 0")
    first = full.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"))
    rep = C.stored(full.join(first, ["n", "s1", "s2"]).select("id", "rep").where("id <> rep"), "copies")
    gone = C.stored(rep.select("id").distinct(), "copy-ids")
    # an id that occurs with several texts keeps all of them
    many = C.stored(base.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").select("id"), "repeated-ids")
    gone = C.bounded(C.stored(gone.join(many, "id", "left_anti"), "dropped"))
    reps = d.join(gone, "id", "left_anti")
    links = _Join(d, full, spec, max_classes).links(reps)   # all keys and pairs hold ids of representatives only
    comp = components(links.select("a", "b").union(rep.select(F.col("rep").alias("a"), F.col("id").alias("b"))))
    return (base.groupBy("id").agg(F.max("n").alias("n_shingles"))
            .join(comp.withColumnRenamed("node", "id"), "id", "left")
            .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("root", "id").alias("component_id")))


def keep_one(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without the documents whose class has a smaller id."""
    gone = C.stored(classes.where(F.col(id_col) != F.col("component_id")).select(id_col), "near-copies")
    return docs.join(C.bounded(gone), id_col, "left_anti")
