import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecheck.llm import multiprobe_search as S
from lakecheck.llm import queries

SCHEMA = "vec_id long, embedding array<double>, score int, v int, qkey int"


def brute(rows, k=10, step=100):
    """Per query row: its k best (distance, id)."""
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    dim = max((len(v) for _, v in ok), default=0)
    m = np.array([list(v) + [0.0] * (dim - len(v)) for _, v in ok]).reshape(len(ok), dim)
    out = []
    for x, (i, _) in enumerate(ok):
        if i % step == 0:
            d = S.distances(m, m[x])
            out.append((i, sorted((float(d[y]), ok[y][0]) for y in range(len(ok)) if y != x)[:k]))
    return out


def got(df):
    by = {}
    for r in df.collect():
        by.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {q: [(s, i) for _, s, i in sorted(f)] for q, f in by.items()}


def recall(found, want):
    hit = sum(len({i for _, i in f} & {i for _, i in found.get(q, [])}) for q, f in want)
    return hit / sum(len(f) for _, f in want)


def data(kind, n=3000, dim=24):
    r = np.random.default_rng(4)
    if kind == "random":
        v = r.normal(size=(n, dim))
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    else:
        v = r.normal(size=(n // 50, dim))[r.integers(0, n // 50, n)] + r.normal(0, 0.05, (n, dim))
    return [(int(i), x.tolist()) for i, x in enumerate(v)]


@pytest.mark.parametrize("kind", ["random", "clusters"])
def test_recall_and_exact_scores(spark, monkeypatch, tmp_dir, kind):
    monkeypatch.setattr(S, "PAGE", 200)
    monkeypatch.setattr(S, "SAMPLE", 256)
    rows = data(kind)
    spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA).write.parquet(f"{tmp_dir}/embeddings.parquet")
    df = queries.op13_multiprobe_search(spark, tmp_dir)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    found, want, of = got(df), brute(rows), dict(rows)
    assert recall(found, want) >= 0.95
    for q, f in found.items():
        assert len(f) == 10 and f == sorted(f)
        assert all(s == pytest.approx(math.dist(of[q], of[i]), rel=1e-12) for s, i in f)


def test_odd_rows_are_whole(spark, monkeypatch):
    """Copies, repeated ids, outliers and rows that take no part; few vectors, so every page is read and nothing is missed."""
    rows = data("clusters", 400, 6)
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(100, rows[100][1]), (100, rows[7][1]), (200, rows[200][1])]
    rows += [(500, None), (600, []), (700, [float("nan")] * 6), (800, [0.0] * 6), (900, [1.0, None]), (None, rows[3][1]), (1100, [1e9, 0.0, 3.0]), (1200, [1e200] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA)
    for few in (SAMPLE_ALL := 1024, 64):
        monkeypatch.setattr(S, "SAMPLE", few)
        out = S.nearest(df, F.col("id") % 100 == 0)
        by = {}
        for r in out.collect():
            by.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        want = {}
        for q, f in brute(rows):
            want.setdefault(q, []).extend(f)
        assert by.keys() == want.keys()
        for q in want:
            assert sorted(i for _, i in by[q]) == sorted(i for _, i in want[q]) or few != SAMPLE_ALL
            assert len(by[q]) == len(want[q])


def test_few_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA)
    assert got(S.nearest(df, F.col("id") % 100 == 0)) == {0: [(0.0, 1), (math.sqrt(8), 2)]}
    assert S.nearest(df.where("vec_id = 0"), F.col("id") % 100 == 0).collect() == []
    assert S.nearest(df.limit(0), F.col("id") % 100 == 0).collect() == []


def test_too_many_pages_are_read_exactly(spark, monkeypatch):
    monkeypatch.setattr(S, "PAGE", 50)
    monkeypatch.setattr(S, "PROBES", 2)
    rows = data("random", 1500, 16)
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA)
    found = got(S.nearest(df, F.col("id") % 100 == 0))
    assert {q: [i for _, i in f] for q, f in found.items()} == {q: [i for _, i in f] for q, f in brute(rows)}
