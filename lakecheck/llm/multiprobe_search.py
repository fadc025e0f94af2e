"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by ``FUNCTIONS`` Gaussian projections, each cut into slots of one width; vectors with equal slots
share a bucket.  Where a query lies in its slots says how likely a neighbour at a given distance falls into a bucket
some slots away: the projections of their difference are normal, so the chances are differences of the normal
distribution function, and a bucket's is their product.  Each query first takes an upper bound of its k-th
distance from its home buckets' page and from the sample.  Then it visits, in every table, the buckets whose chance
is at least a level of its own: neighbours at that distance, drawn by Monte Carlo, fall into such buckets so often that all
tables together reach ``TARGET``.  Candidates of all tables are merged and ranked by exact distance.

Buckets with the same first slots are one page, a row with at most about ``PAGE`` vectors; larger pages are split by hash.
A query enumerates the pages that can hold a likely enough bucket and is joined with them; one whose list would pass
``PROBES`` reads every page of the first table instead, which is exact.  Equal vectors are one entry with its smallest ids.

The slot width and the number of slots that make a page are fitted on the at most ``SAMPLE`` entries with the smallest
hashes (a bounded sample); every entry is indexed.  Nearness and scores are Euclidean, in double precision.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite components, and rows without an id take no
part; vectors shorter than the longest are padded with 0; ties go to the smaller id; a query's own row is no candidate,
but other rows with its id are; fewer candidates than k give fewer rows; no vectors, no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecheck.llm import common as C

TABLES = 3
FUNCTIONS = 12
SAMPLE = 1024              # entries that the widths are fitted on, at most
PAGE = 4096                # entries of a page, about; fewer where vectors are long
TARGET = 0.97              # chance that a neighbour at the k-th distance is met in some table
DRAWS = 1000               # neighbours drawn for a query's level
PROBES = 1 << 16           # pages that a query lists in a table, at most
BLOCK = 256                # queries that visit a page together
FAR = 20                   # slots away that the exact chances reach

_erf = np.frompyfunc(math.erf, 1, 1)
_PAGES = "t int, page binary, salt int, codes binary, edges binary, vectors binary, eids binary, ids array<array<long>>"
_PAGES_ARROW = pa.schema([("t", pa.int32()), ("page", pa.binary()), ("salt", pa.int32()), ("codes", pa.binary()), ("edges", pa.binary()),
                          ("vectors", pa.binary()), ("eids", pa.binary()), ("ids", pa.list_(pa.list_(pa.int64())))])
_FOUND = "qkey long, query_id long, eid long, ids array<long>, score double"


def complete(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    c = F.col(vector_col)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    d = vectors.where(F.col(id_col).isNotNull() & c.isNotNull() & (F.size(c) > 0)).where(fine).where(F.exists(c, lambda x: x != 0))
    return d.select(F.col(id_col).cast("long").alias("id"), F.transform(c, lambda x: x.cast("double")).alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, padded with 0."""
    off, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    n = np.diff(off)
    row = np.repeat(np.arange(len(n)), n)
    out = np.zeros((len(n), dim))
    out[row, np.arange(len(row)) - np.repeat(off[:-1] - off[0], n)] = flat[off[0]:off[-1]]
    return out


def distances(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = v - q
    with np.errstate(over="ignore"):
        return np.sqrt((d * d).sum(axis=1))


class Family:
    """The hash functions, fitted on a sample."""

    def __init__(self, sample: np.ndarray, total: int, seed: int = 1):
        self.sample, self.dim = sample, sample.shape[1]
        r = np.random.Generator(np.random.PCG64(seed))
        self.project = r.normal(size=(TABLES, FUNCTIONS, self.dim))
        self.draws = r.normal(size=(DRAWS, FUNCTIONS))
        near = [np.partition(d, 1)[1] for x in range(min(len(sample), 256)) if len(d := distances(sample, sample[x])) > 1]
        width = float(np.median(near)) if near else 1.0
        self.width = width if 0 < width < math.inf else 1.0
        self.shift = r.uniform(size=(TABLES, FUNCTIONS))
        self.page = max(16, min(PAGE, (4 << 20) // (8 * self.dim)))
        # as many first slots make a page as pages are needed, by the entropy of a slot on the sample
        slots = np.floor(self.places(sample)).reshape(len(sample), -1)
        entropy = [-(p * np.log(p)).sum() for s in slots.T for p in [np.unique(s, return_counts=True)[1] / len(sample)]]
        need = math.log(max(1.0, total / self.page))
        self.prefix = min(FUNCTIONS, math.ceil(need / max(float(np.mean(entropy)), 0.05)))
        self.share = 1 - (1 - TARGET) ** (1 / TABLES)

    def places(self, v: np.ndarray) -> np.ndarray:
        """Where each vector lies on each projection, in slots: (vectors, tables, functions)."""
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.einsum("nd,tfd->ntf", v, self.project) / self.width + self.shift
        return np.clip(np.nan_to_num(x), -2.0 ** 30, 2.0 ** 30)

    def chance(self, away: np.ndarray, inside: np.ndarray, spread: float) -> np.ndarray:
        """Log of the chance that a neighbour's slots lie ``away`` (..., functions) from those of a query that lies
        ``inside`` its slots, when a difference of projections has the standard deviation ``spread`` in slots."""
        if spread >= 3:
            z = (away + 0.5 - inside) / spread
            return (-0.5 * z * z).sum(axis=-1) - away.shape[-1] * math.log(spread * math.sqrt(2 * math.pi))
        return self.each(inside, spread)[np.arange(away.shape[-1]), np.clip(away, -FAR, FAR).astype(np.int64) + FAR].sum(axis=-1)

    @staticmethod
    def each(inside: np.ndarray, spread: float) -> np.ndarray:
        edge = (np.arange(-FAR, FAR + 2)[None, :] - inside[:, None]) / (max(spread, 1e-9) * math.sqrt(2))
        p = np.diff(_erf(edge).astype(float), axis=1) / 2
        return np.log(np.maximum(p, 1e-30))

    def level(self, inside: np.ndarray, spread: float) -> float:
        """Log chance that the buckets of a share of all drawn neighbours reach."""
        if not math.isfinite(spread):
            return -math.inf
        c = self.chance(np.floor(inside + self.draws * spread), inside, spread)
        return float(np.quantile(c, 1 - self.share, method="lower")) - 1e-9

    def pages(self, inside: np.ndarray, spread: float, level: float) -> np.ndarray | None:
        """The first slots, relative to the query's, of all pages that can hold a bucket of the level; None: too many."""
        reach = math.ceil(6 * spread) + 1 if math.isfinite(spread) else 0
        away = np.arange(-min(reach, PROBES), min(reach, PROBES) + 1)
        one = np.stack([self.chance(away[:, None], inside[f:f + 1], spread) for f in range(FUNCTIONS)]) if math.isfinite(spread) else np.zeros((FUNCTIONS, 1))
        best = one.max(axis=1)
        have, at = np.zeros(1), np.zeros((1, 0), dtype=np.int64)
        for f in range(self.prefix):
            rest = best[f + 1:].sum()
            ok = np.flatnonzero(one[f] + have.max(initial=-math.inf) + rest >= level)
            if len(have) * len(ok) > 8 * PROBES:
                return None
            x, y = np.nonzero(have[:, None] + one[f][ok][None, :] + rest >= level)
            have, at = have[x] + one[f][ok[y]], np.concatenate((at[x], away[ok[y]][:, None]), axis=1)
            if len(have) > PROBES:
                return None
        return at


def _hashed(family: Family, full: bool):
    """Entries (v, eid, ids) -> a row for every table: its page, and with ``full`` its slots and the entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 1024):
                part = b.slice(s, 1024)
                code = np.floor(family.places(matrix(part.column(0), family.dim))).astype("<i4")
                for t in range(TABLES):
                    n = part.num_rows
                    page = pa.array([c[:family.prefix].tobytes() for c in code[:, t]], pa.binary())
                    cols = [pa.array(np.full(n, t, dtype=np.int32)), page]
                    if full:
                        cols += [pa.array([c.tobytes() for c in code[:, t]], pa.binary()), *part.columns]
                    yield pa.RecordBatch.from_arrays(cols, ["t", "page", "code", "v", "eid", "ids"][:len(cols)])
    return run


def _page(dim: int):
    """Entries of a page -> one row with its buckets, sorted by slots."""
    def run(key, table):
        code = np.frombuffer(b"".join(table.column("code").to_pylist()), "<i4").reshape(-1, FUNCTIONS)
        uniq, of = np.unique(code, axis=0, return_inverse=True)
        order = np.argsort(of.ravel(), kind="stable")
        edges = np.concatenate(([0], np.cumsum(np.bincount(of.ravel(), minlength=len(uniq)))))
        v = matrix(table.column("v").combine_chunks(), dim)[order]
        eids = table.column("eid").to_numpy()[order]
        ids = table.column("ids").combine_chunks().take(pa.array(order))
        row = {"t": key[0].as_py(), "page": key[1].as_py(), "salt": key[2].as_py(), "codes": uniq.astype("<i4").tobytes(), "edges": edges.astype("<i8").tobytes(),
               "vectors": v.astype("<f8").tobytes(), "eids": eids.astype("<i8").tobytes(), "ids": ids.to_pylist()}
        return pa.Table.from_pylist([row], schema=_PAGES_ARROW)
    return run


def _home(family: Family, k: int):
    """Queries (v, qkey, query_id) -> their k-th distance to sample entries and home page in every table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = matrix(b.column(0), family.dim)
            code = np.floor(family.places(q)).astype("<i4")
            far = []
            for x in q:
                d = distances(family.sample, x)[(family.sample != x).any(axis=1)]
                far.append(float(np.partition(d, k - 1)[k - 1]) if len(d) >= k else math.inf)
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(q), t, dtype=np.int32)), pa.array([c[:family.prefix].tobytes() for c in code[:, t]], pa.binary()),
                                                  pa.array(far, pa.float64()), pa.array(np.full(len(q), -math.inf))], ["v", "qkey", "query_id", "t", "page", "far", "level"])
    return run


_PROBE = "v array<double>, qkey long, query_id long, t int, page binary, far double, level double"


def _probes(family: Family):
    """Queries (v, qkey, query_id, far) -> the pages to visit in every table and the level of their buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = family.places(matrix(b.column(0), family.dim))
            home = np.floor(at)
            for x, far in enumerate(b.column(3).to_pylist()):
                rows, spread = [], far / family.width
                for t in range(TABLES):
                    inside = at[x, t] - home[x, t]
                    level = family.level(inside, spread)
                    pages = family.pages(inside, spread, level)
                    if pages is None:                      # every page of the first table: exact
                        rows = [(0, None, -math.inf)]
                        break
                    first = home[x, t, :family.prefix].astype(np.int64)
                    rows += [(t, p.tobytes(), level) for p in (first + pages).astype("<i4")]
                one = b.take(pa.array(np.full(len(rows), x)))
                yield pa.RecordBatch.from_arrays([one.column(0), one.column(1), one.column(2), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                                  one.column(3), pa.array([r[2] for r in rows], pa.float64())], ["v", "qkey", "query_id", "t", "page", "far", "level"])
    return run


def _visit(family: Family, k: int):
    """(page, packed queries) -> each query's nearest entries of the page's likely buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                codes = np.frombuffer(row["codes"], "<i4").reshape(-1, FUNCTIONS)
                edges = np.frombuffer(row["edges"], "<i8")
                v, eids = np.frombuffer(row["vectors"], "<f8").reshape(-1, family.dim), np.frombuffer(row["eids"], "<i8")
                out: list[tuple] = []
                for r in row["queries"]:
                    q = np.zeros(family.dim)
                    q[:len(r["v"])] = r["v"]
                    at = family.places(q[None, :])[0, row["t"]]
                    home = np.floor(at)
                    buckets = np.arange(len(codes))
                    if r["level"] > -math.inf:
                        c = family.chance(codes - home, at - home, r["far"] / family.width)
                        order = np.argsort(-c, kind="stable")                   # likeliest first, down to the level
                        buckets = order[:np.searchsorted(-c[order], -r["level"], side="right")]
                    n = edges[buckets + 1] - edges[buckets]
                    pos = np.repeat(edges[buckets] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    d = distances(v[pos], q)
                    ok = d <= r["far"]
                    pos, d = pos[ok], d[ok]
                    if len(pos) > k + 1:                                        # the own entry may be among them
                        ok = d <= np.partition(d, k)[k]
                        pos, d = pos[ok], d[ok]
                    found = sorted((float(e), row["ids"][p], p) for e, p in zip(d, pos.tolist()))[:k + 1]
                    for e, ids, p in found:
                        if e == 0 and r["query_id"] in ids and (v[p] == q).all():
                            ids = list(ids)
                            ids.remove(r["query_id"])
                        out.append((r["qkey"], r["query_id"], int(eids[p]), ids[:k], e))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in out], kind) for c, kind in enumerate(kinds)], ["qkey", "query_id", "eid", "ids", "score"])
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k nearest rows found.  ``is_query`` is a condition on ``id``."""
    spark = vectors.sparkSession
    points = C.stored(complete(vectors, id_col, vector_col).withColumn("qkey", F.monotonically_increasing_id()), "points")
    w = Window.partitionBy("v").orderBy("id")
    entries = points.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = C.stored(entries.withColumn("eid", F.monotonically_increasing_id()).select("v", "eid", "ids"), "entries")
    size = entries.agg(F.count("*"), F.max(F.size("v"))).first()
    if not size[0]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = entries.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    rows = np.zeros((len(sample), size[1]))
    for x, r in enumerate(sample):
        rows[x, :len(r["v"])] = r["v"]
    family = Family(rows, size[0])

    parts = entries.mapInArrow(_hashed(family, False), "t int, page binary").groupBy("t", "page").agg(
        F.ceil(F.count("*") / F.lit(family.page)).cast("int").alias("parts"))
    hashed = entries.mapInArrow(_hashed(family, True), "t int, page binary, code binary, v array<double>, eid long, ids array<long>")
    dealt = hashed.join(C.bounded(C.stored(parts, "page-parts")), ["t", "page"]).withColumn("salt", F.pmod(F.xxhash64("eid"), F.col("parts")).cast("int"))
    pages = C.stored(dealt.groupBy("t", "page", "salt").applyInArrow(_page(family.dim), _PAGES), "pages")

    queries = C.stored(points.where(is_query).select("v", "qkey", F.col("id").alias("query_id")), "queries")
    blocks = max(1, -(-queries.count() // BLOCK))

    def visit(probes: DataFrame, pages: DataFrame, on: list[str]) -> DataFrame:
        packed = probes.groupBy(*on, F.pmod(F.xxhash64("qkey"), F.lit(blocks)).alias("b")).agg(
            F.collect_list(F.struct("qkey", "query_id", "v", "far", "level")).alias("queries"))
        return pages.join(packed.drop("b"), on).select(*pages.columns, "queries").mapInArrow(_visit(family, k), _FOUND)

    home = C.stored(queries.mapInArrow(_home(family, k), _PROBE), "home")
    first = C.stored(visit(home, pages.where("salt = 0"), ["t", "page"]), "first")
    other = first.where(F.size("ids") > 0).select("qkey", "eid", "score").distinct()
    kth = other.withColumn("r", F.row_number().over(Window.partitionBy("qkey").orderBy("score"))).where(F.col("r") == k).select("qkey", F.col("score").alias("kth"))
    far = home.where("t = 0").join(kth, "qkey", "left").select("v", "qkey", "query_id", F.least("far", F.coalesce("kth", "far")).alias("far"))
    probes = C.stored(far.mapInArrow(_probes(family), _PROBE), "probes")
    found = first.union(visit(probes.where("page is not null"), pages, ["t", "page"])).union(
        visit(probes.where("page is null").drop("page"), pages.where("t = 0"), ["t"]))
    each = found.dropDuplicates(["qkey", "eid"]).select("qkey", "query_id", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("qkey").orderBy("score", "vec_id")
    return each.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
