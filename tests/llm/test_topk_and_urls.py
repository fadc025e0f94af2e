import math
import random
import re

import numpy as np

from lakecheck.llm import topk_search as K
from lakecheck.llm import url_filters as U
from pyspark.sql import functions as F


def brute(rows, k, step=50):
    """One row per query row and rank; every other row is a candidate, one with the same id too."""
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for x, (i, q) in enumerate(ok):
        if i % step == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), j) for y, (j, v) in enumerate(ok) if y != x)[:k]
            out += [(i, r + 1, j, max(-2 ** 63, min(2 ** 63 - 1, -n))) for r, (n, j) in enumerate(s)]
    return sorted(out)


def found(spark, rows, schema="vec_id long, embedding array<double>, score int"):
    return sorted(tuple(x) for x in K.top_k(spark.createDataFrame([(i, v, 1) for i, v in rows], schema), F.col("id") % 50 == 0).collect())


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(K, "SUBTREE", 60)
    r = np.random.default_rng(3)
    mid = r.normal(0, 0.2, (8, 12))
    rows = [(i, (mid[i % 8] + r.normal(0, 0.1, 12)).tolist()) for i in range(420)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(2000, None), (2050, [float("nan")] * 12), (2100, [None] * 12), (2150, []), (None, rows[5][1])]
    rows += [(50, rows[50][1]), (50, rows[60][1]), (7, rows[3][1]), (7, rows[3][1]), (100, rows[100][1])]     # repeated ids and rows
    assert found(spark, rows) == brute(rows, 5)
    assert found(spark, rows[:3]) == brute(rows[:3], 5)
    assert found(spark, rows[:1]) == [] == found(spark, rows[:0])


def test_scores_of_large_vectors_are_exact(spark, monkeypatch):
    monkeypatch.setattr(K, "SUBTREE", 40)
    r = np.random.default_rng(4)
    rows = [(i, (2e8 + r.integers(-3, 3, 6) * 0.5).tolist()) for i in range(150)]           # sums beyond 2^53, close together
    assert found(spark, rows) == brute(rows, 5)
    rows = [(i, (r.normal(0, 1, 6) * 10.0 ** r.integers(-2, 9)).tolist()) for i in range(150)]
    assert found(spark, rows) == brute(rows, 5)
    rows = [(0, [1e12, 1.0]), (1, [1e12, 2.0]), (2, [-1e12, 0.0]), (3, [1e300, 0.0]), (4, [5.0, 5.0])]      # scores beyond a long
    got = found(spark, rows)
    assert [x[3] for x in got] == sorted((x[3] for x in brute(rows, 5)), reverse=True) and {x[2] for x in got} == {1, 2, 3, 4}


def test_rules_and_templates(spark):
    urls = ["http://A.Example.COM/en/1?x#y", "https://www.example.com/en/2", "http://x.example.com/de/", "http://q.net/fr/7", "http://q.net/en/7",
            None, "no scheme/com/", "http://net/es/", "http://anet/es/1", "http://h.org", "ftp://h.org#f", "", "http://q.net/en/8", "http://q.net/en/8"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    got = {r["page_id"]: tuple(r)[1:5] for r in U.judge(df).collect()}
    assert got == {0: ("a.example.com", "/en/1", "example.com/en/", "block"), 1: ("www.example.com", "/en/2", "www.example.com/en/", "allow"),
                   2: ("x.example.com", "/de/", "com/", "allow"), 3: ("q.net", "/fr/7", "net/fr/", "block"), 4: ("q.net", "/en/7", None, "allow"),
                   5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("net", "/es/", "net/es/", "block"), 8: ("anet", "/es/1", None, "allow"),
                   9: ("h.org", "", None, "allow"), 10: ("h.org", "", None, "allow"), 11: ("", "", None, "allow"), 12: ("q.net", "/en/8", None, "allow"),
                   13: ("q.net", "/en/8", None, "allow")}
    assert U.judge(df.limit(0)).collect() == []


def test_bad_templates_are_rejected(spark):
    rows = [(i, f"http://s.org/{'spam' if i % 2 else 'ham'}/{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{i}/p") for i in range(400)]
    rows += [(1000 + i, f"http://s.org/tags/{'x' * (i + 1)}") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    lab = spark.createDataFrame([(i, i % 2) for i in range(0, 400, 1) if i % 3], "page_id long, bad int")
    got = U.judge(df, lab).collect()
    assert {(r["template"], r["verdict"]) for r in got if r["page_id"] < 400} == {("/spam/*/p", "block"), ("/ham/*/p", "allow")}
    assert {r["template"] for r in got if r["page_id"] >= 1000} <= {"/tags/*", *("/tags/" + "x" * k for k in range(1, 41))}


def plain_templates(urls):
    """{(host, path): template} by the written rules, level by level in plain Python."""
    def split(u):
        if u is None or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):]).group()
    n = {}
    for u in urls:
        n[split(u)] = n.get(split(u), 0) + 1
    segs = {p: re.sub("^/", "", p[1]).split("/") for p in n}
    out = {p: "" if p[1] == "" else "/" for p in n}
    for k in range(max(map(len, segs.values()), default=0)):
        value = {p: "*" if re.search("[0-9]", s[k]) else s[k] for p, s in segs.items() if len(s) > k}
        count, whole = {}, {}
        for p, v in value.items():
            count[p[0], out[p], v] = count.get((p[0], out[p], v), 0) + n[p]
        for (h, t, v), x in count.items():
            whole.setdefault((h, t), {})[v] = x
        new = {}
        for p, v in value.items():
            b = whole[p[0], out[p]]
            wild = len(b) > U.MAX_BRANCHES and b[v] < sum(b.values()) * U.MIN_SHARE
            new[p] = out[p] + ("*" if wild else v) + ("/" if len(segs[p]) > k + 1 else "")
        out |= new
    return out, split


def plain_verdicts(rows, labels):
    """{page: (template, bad share)}: pools of siblings, z-test, smoothing."""
    of, split = plain_templates([u for _, u in rows])
    t = {}
    for i, u in rows:
        c = t.setdefault((split(u)[0], of[split(u)]), [0, 0])
        if labels.get(i) is not None:
            c[0] += 1
            c[1] += labels[i]
    parent = lambda x: (re.match(r"^(.*/)[^/]*/?$", x) or [None, ""])[1]
    total = [sum(c[x] for c in t.values()) for x in (0, 1)]
    rate, share = total[1] / total[0] if total[0] else 0.0, {}
    for (h, x), (n, b) in t.items():
        hn, hb = (sum(c[y] for (g, _), c in t.items() if g == h) for y in (0, 1))
        pn, pb = (sum(c[y] for (g, z), c in t.items() if g == h and parent(z) == parent(x)) for y in (0, 1))
        r = pb / pn if pn else 0.0
        z = (b / n - r) / math.sqrt(r * (1 - r) / n) if n and 0 < r < 1 else 0.0
        if abs(z) < U.Z:
            n, b = pn, pb
        share[h, x] = (b + U.SMOOTH * (hb + U.SMOOTH * rate) / (hn + U.SMOOTH)) / (n + U.SMOOTH)
    return {i: (of[split(u)], share[split(u)[0], of[split(u)]]) for i, u in rows}


def test_template_tree_against_plain_python(spark):
    r = random.Random(8)
    deep = ["a", "b", "c", "d", "e", "f7", "g", "h"]
    rows = [(i, f"http://deep.org/{'/'.join(deep[:r.randrange(1, 9)])}/{r.choice(['good', 'bad'])}/{r.choice('xyz')}{r.randrange(30)}") for i in range(500)]
    rows += [(1000 + i, f"https://Wide.org/{''.join(r.choice('abcdefghij') for _ in range(3))}/{r.choice(['p', 'q'])}") for i in range(300)]
    rows += [(2000 + i, u) for i, u in enumerate([None, "", "x", "http://", "http://one.org", "http://one.org/", "http://one.org//", "http://one.org/a//b/", "http://two.org/" + "s/" * 300 + "t"])]
    rows += [(3000, rows[3][1]), (3001, rows[3][1])]
    labels = {i: int("bad" in (u or "") if r.random() < 0.9 else r.random() < 0.5) for i, u in rows if r.random() < 0.6}
    got = U.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(list(labels.items()), "page_id long, bad int")).collect()
    want = plain_verdicts(rows, labels)
    assert len(got) == len(rows)
    for g in got:
        template, bad = want[g["page_id"]]
        assert g["template"] == template and abs(g["bad_share"] - bad) < 1e-9
        if g["rule"] is None:
            assert g["verdict"] == ("block" if bad >= U.REJECT else "allow")


def test_sections_that_part_deep_down_are_told_apart(spark):
    rows = [(i, f"http://s.org/a/b/c/d/{'spam' if i % 2 else 'ham'}/{i}") for i in range(200)]
    got = U.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([(i, i % 2) for i in range(200)], "page_id long, bad int"))
    assert {(r["template"], r["verdict"]) for r in got.collect()} == {("/a/b/c/d/spam/*", "block"), ("/a/b/c/d/ham/*", "allow")}
