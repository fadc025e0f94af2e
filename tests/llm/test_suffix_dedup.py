import hashlib
import random

import pytest

from lakecheck.llm import suffix_dedup as S


def brute(rows, n):
    seen = {}
    for _, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - n + 1):
            seen[b[i:i + n]] = seen.get(b[i:i + n], 0) + 1
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        spans = S.merge((i, i + n) for i in range(len(b) - n + 1) if seen[b[i:i + n]] > 1)
        kept = b"".join(b[e:s] for e, s in zip([0] + [e for _, e in spans], [s for s, _ in spans] + [len(b)]))
        out[d] = (len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    return out


def rows(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randrange(2, 9)))
    text = lambda k: "".join(word() for _ in range(k))
    shared = [text(r.randrange(5, 120)) for _ in range(12)]
    out = []
    for i in range(120):
        parts = [text(r.randrange(0, 60)) if r.random() < 0.6 else r.choice(shared)[r.randrange(9):] for _ in range(r.randrange(1, 6))]
        out.append((i, "".join(parts)))
    out += [(500, None), (501, ""), (502, "x"), (503, "a" * (3 * n)), (504, "ab" * n), (505, "abc" * n + "é" * n), (506, out[3][1]), (507, out[3][1])]
    return out + [(510, "q" + "a" * n), (511, "ba" * n + "z")]


@pytest.mark.parametrize("seed,n,crowded", [(1, 200, 20000), (2, 60, 2), (4, 12, 20000)])
def test_against_brute_force(spark, seed, n, crowded):
    data = rows(seed, n)
    df = spark.createDataFrame([(i, t, 1) for i, t in data], "doc_id long, text string, start int")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.cut_repeats(df, length=n, crowded=crowded).collect()}
    assert got == brute(data, n)


def test_empty_table(spark):
    assert S.cut_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
