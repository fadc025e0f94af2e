"""Exact top-k inner-product search with an M-tree.

Vectors become points of equal norm by one more coordinate, sqrt(R - |v|^2) with R the largest squared norm, and
queries get 0 there: order by inner product is then order by distance, a metric.  Equal vectors are one
entry with its smallest ids.  The tree has three levels: subtrees around routing vectors, leaf pages around
a routing member, entries.  Every page keeps its covering radius and the distance to its parent, every entry the
distance to its page's routing vector.

Spark deals entries to the nearest routing vector and splits crowded subtrees by a hash; a subtree's pages are
one row.  A query first searches its nearest subtree, best first: pages in order of their lower bound, none whose
bound exceeds the k-th distance, and the distance to a page's routing vector is not even computed where
the parent distances bound it by the triangle inequality.  The k-th distance then prunes the other
subtrees; the rest are searched in blocks of queries.  Bounds are widened by what rounding can do to a distance at
the vectors' norms, and scores are exact integers: in doubles where no sum can pass 2^52, else in Python's.

The routing vectors are the at most ``ROUTES`` entries with the smallest hashes (a bounded sample); every
entry is indexed and the search is exact for any choice.

Defined cases: vectors that are NULL, empty or hold NULL or non-finite components take no part; vectors shorter
than the longest are padded with 0; ties go to the smaller id; rows with a repeated id count as rows of their own: each is a
query, and only a query's own row is no candidate of it; a component beyond 2^55 / scale counts as that, and a
score beyond a long as the nearest long, after ranking; fewer candidates than k give fewer rows; no vectors, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecheck.llm import common as C

ROUTES = 1024          # routing vectors, at most
SUBTREE = 4096         # entries of a subtree, about
PAGE = 256             # entries of a leaf page, at most
BLOCK = 512            # queries searched together
LARGEST = 1 << 55      # of a quantised component; products of such vectors fit decimal(38)
LONG = (1 << 63) - 1


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * component) of the complete vectors."""
    most = F.lit(float(LARGEST))
    x = F.transform(F.col(vector_col), lambda c: F.floor(F.greatest(-most, F.least(most, F.lit(float(scale)) * c.cast("double")))).cast("long"))
    fine = F.forall(F.col(vector_col), lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    d = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).where(fine)
    return d.select(F.col(id_col).cast("long").alias("id"), x.alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a float64 matrix, padded with 0."""
    off, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    n = np.diff(off)
    out = np.zeros((len(n), dim))
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(row)) - np.repeat(off[:-1] - off[0], n)] = flat[off[0]:off[-1]]
    return out


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column of longs, padded with 0."""
    out = np.zeros((len(column), dim), dtype="<i8")
    off, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    n = np.diff(off)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(row)) - np.repeat(off[:-1] - off[0], n)] = flat[off[0]:off[-1]]
    return out


def _lift(v: np.ndarray, big: float) -> np.ndarray:
    return np.concatenate((v, np.sqrt(np.maximum(0.0, big - (v * v).sum(axis=1, keepdims=True)))), axis=1)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0.0))


def _slack(big: float, dim: int) -> float:
    """What rounding can add to or take from a bound made of some distances between points of squared norm ``big``."""
    return 8 * float(np.sqrt((dim + 8) * 2.0 ** -52 * max(big, 1.0)))


def _nearest(routes: np.ndarray, big: float, dim: int, names: list[str]):
    """Rows (v, rest...) -> rest and the nearest routing vector of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = [_distance(_lift(_matrix(b.column(0).slice(s, 1024), dim), big), routes).argmin(axis=1) for s in range(0, b.num_rows, 1024)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(r).astype(np.int32) if r else [], pa.int32())], [*names, "route"])
    return run


def _pages(routes: np.ndarray, big: float, dim: int):
    """Entries of a subtree -> one row: its radius and its leaf pages, packed."""
    def run(key, table):
        route = key[0].as_py()
        ints = _integers(table.column("v").combine_chunks(), dim)
        v = ints.astype(float)
        ids = table.column("ids").to_pylist()
        x, root = _lift(v, big), routes[route][None, :]
        todo, leaves = [np.arange(len(v))], []
        while todo:                                     # split around two far members until pages are small
            m = todo.pop()
            if len(m) > PAGE:
                a = x[m[_distance(x[m], x[m[:1]])[:, 0].argmax()]][None, :]
                da = _distance(x[m], a)[:, 0]
                db = _distance(x[m], x[m[da.argmax()]][None, :])[:, 0]
                o = np.argsort(da - db, kind="stable")
                todo += [m[o[:len(m) // 2]], m[o[len(m) // 2:]]]
            else:
                leaves.append(m)
        mid = [m[_distance(x[m], x[m].mean(axis=0)[None, :])[:, 0].argmin()] for m in leaves]
        order = np.concatenate(leaves)
        member = np.concatenate([_distance(x[m], x[c][None, :])[:, 0] for m, c in zip(leaves, mid)])
        radius = [float(_distance(x[m], x[c][None, :]).max()) for m, c in zip(leaves, mid)]
        parent = _distance(x[mid], root)[:, 0]
        flat = [i for k in order for i in ids[k]]
        row = {"route": route, "salt": key[1].as_py(), "radius": float(_distance(x, root).max()), "vectors": ints[order].tobytes(),
               "sizes": [len(m) for m in leaves], "mids": ints[mid].tobytes(), "radii": radius, "parents": parent.tolist(),
               "members": member.tolist(), "ids": flat, "id_counts": [len(ids[k]) for k in order]}
        return pa.Table.from_pylist([row], schema=_TREE_ARROW)
    return run


_TREE = ("route int, salt int, radius double, vectors binary, sizes array<int>, mids binary, radii array<double>, parents array<double>, "
         "members array<double>, ids array<long>, id_counts array<int>")
_TREE_ARROW = pa.schema([("route", pa.int32()), ("salt", pa.int32()), ("radius", pa.float64()), ("vectors", pa.binary()),
                         ("sizes", pa.list_(pa.int32())), ("mids", pa.binary()), ("radii", pa.list_(pa.float64())),
                         ("parents", pa.list_(pa.float64())), ("members", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())),
                         ("id_counts", pa.list_(pa.int32()))])


def _best(best: list, ids: np.ndarray, scores: np.ndarray, k: int) -> list:
    """The k best (-score, id) of a list and of new candidates; scores are whole numbers, as doubles or as objects."""
    if len(best) == k:
        ok = (scores >= -best[-1][0]).astype(bool)
        ids, scores = ids[ok], scores[ok]
    if scores.dtype == object:
        o = sorted(range(len(ids)), key=lambda x: (-scores[x], ids[x]))[:k]
    else:
        o = np.lexsort((ids, -scores))[:k]
    return sorted(best + [(-int(scores[x]), int(ids[x])) for x in o])[:k]


def search_subtree(tree: dict, route: np.ndarray, q: np.ndarray, own: list[int], floor: list, k: int, big: float, dim: int) -> list[list]:
    """Best-first search of one subtree for some queries (whole numbers).  ``floor``: each query's k-th best score so far, or None."""
    ints = np.frombuffer(tree["vectors"], dtype="<i8").reshape(-1, dim)
    v, qf = ints.astype(float), q.astype(float)
    mids = _lift(np.frombuffer(tree["mids"], dtype="<i8").reshape(-1, dim).astype(float), big)
    radii, parents, members = (np.array(tree[c]) for c in ("radii", "parents", "members"))
    edge = np.concatenate(([0], np.cumsum(tree["sizes"])))
    ids, counts = np.array(tree["ids"], dtype=np.int64), np.array(tree["id_counts"])
    at = np.concatenate(([0], np.cumsum(counts)))
    lifted = np.concatenate((qf, np.zeros((len(q), 1))), axis=1)
    to_root = _distance(lifted, route[None, :])[:, 0]
    norm, slack = (qf * qf).sum(axis=1), _slack(big, dim)
    length, qlength = np.sqrt((v * v).sum(axis=1)), np.sqrt(norm)
    out = []
    for x in range(len(q)):
        best: list = []
        found_own = False

        def limit() -> float:                       # the k-th distance
            low = floor[x] if floor[x] is not None else -np.inf
            if len(best) == k:
                low = max(low, -best[-1][0])
            return np.inf if low == -np.inf else float(np.sqrt(max(0.0, norm[x] + big - 2 * float(low)))) + slack
        near = np.maximum(0.0, np.abs(to_root[x] - parents) - radii)      # bound by the stored parent distances
        open_ = np.flatnonzero(near <= limit())
        d = _distance(lifted[x:x + 1], mids[open_])[0]
        bound = np.maximum(0.0, d - radii[open_])
        for y in np.argsort(bound, kind="stable"):
            cap = limit()
            if bound[y] > cap:
                break
            p = open_[y]
            rows = np.arange(edge[p], edge[p + 1])
            rows = rows[np.abs(d[y] - members[rows]) <= cap]              # bound by the entries' distances
            if len(rows):
                if float(length[rows].max()) * qlength[x] < 2.0 ** 52:
                    s = v[rows] @ qf[x]
                else:
                    s = ints[rows].astype(object) @ q[x].astype(object)
                n = counts[rows]
                of = np.repeat(np.arange(len(rows)), n)
                pos = np.repeat(at[rows], n) + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                if not found_own:                                         # the query's own row is no candidate
                    same = [z for z in np.flatnonzero(ids[pos] == own[x]) if (ints[rows[of[z]]] == q[x]).all()][:1]
                    if same:
                        found_own, of, pos = True, np.delete(of, same), np.delete(pos, same)
                best = _best(best, ids[pos], s[of], k)
        out.append(best)
    return out


def _search(routes: np.ndarray, k: int, big: float, dim: int):
    """(subtree, packed queries) -> (qkey, query_id, vec_id, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                qs = row.pop("queries")
                q = np.zeros((len(qs), dim), dtype=np.int64)
                for x, r in enumerate(qs):
                    q[x, :len(r["v"])] = r["v"]
                found = search_subtree(row, routes[row["route"]], q, [r["query_id"] for r in qs], [r["floor"] for r in qs], k, big, dim)
                flat = [(r["qkey"], r["query_id"], i, Decimal(-s)) for r, f in zip(qs, found) for s, i in f]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in flat], t) for c, t in enumerate(kinds)], ["qkey", "query_id", "vec_id", "score"])
    return run


def _other_subtrees(routes: np.ndarray, nodes: list[tuple[int, int, float]], big: float, dim: int):
    """(v, qkey, query_id, floor, done) -> the other subtrees whose bound does not exceed the k-th distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        route, salt = np.array([n[0] for n in nodes]), np.array([n[1] for n in nodes])
        radius = np.array([n[2] for n in nodes])
        step = max(1, (1 << 20) // max(1, len(nodes)))                    # bounds the matrix of queries and subtrees
        for b in (whole.slice(s, step) for whole in batches for s in range(0, whole.num_rows, step)):
            q = _matrix(b.column(0), dim)
            low = np.array([-np.inf if f is None else float(f) for f in b.column(3).to_pylist()])
            cap = np.sqrt(np.maximum(0.0, (q * q).sum(axis=1) + big - 2 * low)) + _slack(big, dim)
            d = _distance(np.concatenate((q, np.zeros((len(q), 1))), axis=1), routes)[:, route]
            x, y = np.nonzero((np.maximum(0.0, d - radius) <= cap[:, None]) & (b.column(4).to_numpy()[:, None] != route))
            take = b.take(pa.array(x))
            yield pa.RecordBatch.from_arrays([*take.columns[:4], pa.array(route[y], pa.int32()), pa.array(salt[y], pa.int32())],
                                             ["v", "qkey", "query_id", "floor", "route", "salt"])
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k rows of highest integer inner product."""
    spark = vectors.sparkSession
    allv = C.stored(quantised(vectors, id_col, vector_col, scale).withColumn("qkey", F.monotonically_increasing_id()), "points")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    size = allv.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c)).alias("big"),
                    F.max(F.size("v")).alias("dim")).first()
    if not size["n"]:
        return empty
    big, dim = float(size["big"]), size["dim"]
    # equal vectors are one entry with its k + 1 smallest ids, repeats included: enough for any query, its own row left out
    w = Window.partitionBy("v").orderBy("id")
    entry = (allv.withColumn("r", F.row_number().over(w)).where(f"r <= {k + 1}").groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    entry = C.stored(entry, "entries")
    total = entry.count()
    count = max(1, min(ROUTES, total // SUBTREE + 1))
    sample = entry.select("v").orderBy(F.xxhash64("v"), "v").limit(count).collect()
    routes = np.zeros((len(sample), dim))
    for x, r in enumerate(sample):
        routes[x, :len(r["v"])] = r["v"]
    routes = _lift(routes, big)
    placed = C.stored(entry.select("v", "ids").mapInArrow(_nearest(routes, big, dim, ["v", "ids"]), "v array<long>, ids array<long>, route int"), "placed")
    parts = placed.groupBy("route").agg(F.ceil(F.count("*") / F.lit(2 * SUBTREE)).cast("int").alias("parts"))
    dealt = placed.join(F.broadcast(parts), "route").withColumn("salt", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
    tree = C.stored(dealt.select("route", "salt", "v", "ids").groupBy("route", "salt").applyInArrow(_pages(routes, big, dim), _TREE), "m-tree")
    nodes = [tuple(r) for r in tree.select("route", "salt", "radius").collect()]     # one per subtree: entries / 4096
    queries = allv.where(is_query).select("v", "qkey", F.col("id").alias("query_id"))
    first = C.stored(queries.mapInArrow(_nearest(routes, big, dim, ["v", "qkey", "query_id"]), "v array<long>, qkey long, query_id long, route int"), "queries")

    def visit(q: DataFrame) -> DataFrame:
        block = F.pmod(F.xxhash64("qkey"), F.lit(max(1, -(-first_count // BLOCK))))
        packed = q.groupBy("route", *(["salt"] if "salt" in q.columns else []), block.alias("b")).agg(F.collect_list(F.struct("qkey", "query_id", "v", "floor")).alias("queries"))
        on = ["route", "salt"] if "salt" in q.columns else ["route"]
        rows = tree.join(packed.drop("b"), on)
        return rows.select(*_TREE_ARROW.names, "queries").mapInArrow(_search(routes, k, big, dim), "qkey long, query_id long, vec_id long, score decimal(38,0)")

    first_count = first.count()
    order = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    near = C.stored(visit(first.withColumn("floor", F.lit(None).cast("decimal(38,0)"))), "near")
    kth = near.withColumn("r", F.row_number().over(order)).where(f"r = {k}").select("qkey", F.col("score").alias("floor"))
    more = first.join(kth, "qkey", "left").select("v", "qkey", "query_id", "floor", "route")
    more = C.stored(more.mapInArrow(_other_subtrees(routes, nodes, big, dim), "v array<long>, qkey long, query_id long, floor decimal(38,0), route int, salt int"), "visits")
    found = near.union(visit(more))                 # a subtree is visited once by a query, so no row is found twice
    score = F.greatest(F.lit(-LONG - 1).cast("decimal(38,0)"), F.least(F.lit(LONG).cast("decimal(38,0)"), F.col("score"))).cast("long")
    return found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
