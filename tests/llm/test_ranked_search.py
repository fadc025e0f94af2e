import math
import random
import re

import numpy as np
import pytest

from lakecheck.llm import queries
from lakecheck.llm import ranked_search as R

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    have = [(i, terms(t)) for i, t in docs]
    have = [(i, t) for i, t in have if t]
    n_docs, length, df = len(have), sum(len(t) for _, t in have), {}
    for _, t in have:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        found = []
        for i, t in have:
            m, s = 25 + (75 * len(t) * n_docs) // length, 0
            for x in terms(text):
                if tf := t.count(x):
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10 ** 9 * tf // (1000 * tf + 8 * m))
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def corpus():
    r = random.Random(2)
    vocab = ["".join(r.choice("abcdeéß") for _ in range(r.randrange(1, 6))) for _ in range(300)]
    docs = [(i, " ".join(r.choice(vocab) for _ in range(r.choice((1, 5, 40, 400))))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)] + [(i % 3, "Common rare, words!") for i in range(120)]
    docs += [(2000, None), (2001, ""), (2002, " -- \n"), (None, docs[3][1]), (None, docs[3][1]), (2003, "x\x00Y z " * 20_000 + "été ÉTÉ")]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice((1, 3, 30))))) for i in range(20)]
    items += [(20, docs[7][1]), (21, "COMMON common common words"), (21, "rare"), (22, None), (23, ""), (24, "nowhere-else"), (None, "été x"), (25, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("block, chunk", [(512, 1024), (7, 50)])
def test_against_brute_force(spark, monkeypatch, tmp_dir, block, chunk):
    monkeypatch.setattr(R, "BLOCK", block)
    monkeypatch.setattr(R, "CHUNK", chunk)
    docs, items = corpus()
    spark.createDataFrame([(i, t, 1, "x", 1) for i, t in docs], "doc_id long, text string, score int, terms string, key int").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, key int").write.parquet(f"{tmp_dir}/benchmark.parquet")
    got = queries.op12_ranked_search(spark, tmp_dir)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert R.search(docs.limit(0), items).collect() == [] == R.search(docs, items.limit(0)).collect()
    assert [tuple(r) for r in R.search(docs, items).collect()] == brute([(1, "a b")], [(1, "a")])


def test_bounds_hold():
    r = random.Random(5)
    for _ in range(200):
        words = [str(r.randrange(10 ** 6)).encode() for _ in range(r.randrange(1, 200))]
        tf, m = np.array([r.choice((1, 2, 9, 10 ** 6)) for _ in words]), r.randrange(25, 5000)
        s = R.sketch(words, tf, m)
        assert len(s) >= 4 * len(words) and len(s) & (len(s) - 1) == 0
        assert (s[R.coordinates(words, len(s))].astype(int) * R.SCALE >= R.impact(tf, m) * 255).all()
