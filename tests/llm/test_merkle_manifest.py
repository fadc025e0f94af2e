import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lakecheck.llm import merkle_manifest as M
from lakecheck.llm import queries

H = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf int, tree string, pos int, h string, path int"


def leaf(i, text, lang, source, n):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def climb(nodes, k=8):
    """Root and, for every node, its path of (before, after)."""
    if len(nodes) == 1:
        return nodes[0], [[]]
    runs = [nodes[s:s + k] for s in range(0, len(nodes), k)]
    root, up = climb([H(*r) for r in runs], k)
    return root, [[("".join(r[:j]), "".join(r[j + 1:]))] + up[x] for x, r in enumerate(runs) for j in range(len(r))]


def lowered(t):
    return None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        of = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((of, *climb([leaf(*r) for r in of])))
    root, tops = climb([t[1] for t in trees]) if trees else (None, [])
    out = []
    for (of, sub, paths), top in zip(trees, tops):
        for r, p in zip(of, paths):
            path = p + top
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            h = leaf(r[0], lowered(r[1]), *r[2:]) if bad else leaf(*r)
            for before, after in path:
                h = H(before, h, after)
            out.append((r[0], leaf(*r), sub, root, H(*[x for b in path for x in b]), h, h == root))
    return sorted(out, key=str)


def run(spark, tmp_dir, rows, name):
    spark.createDataFrame([(*r, 1, "t", 2, "h", 3) for r in rows], SCHEMA).write.parquet(f"{tmp_dir}/{name}/documents.parquet")
    return queries.op11_merkle_manifest(spark, f"{tmp_dir}/{name}")


def test_against_brute_force(spark, tmp_dir):
    big = [(i * 7 % 1000, f"Text {i} Ä" * (i % 4), "en", "s", i) for i in range(600)]
    rows = big + [(i, "lower case" if i % 2 else "UPPER", lang, None, None) for lang, n in (("de", 9), ("é", 8), ("Z", 1), (None, 65), ("", 2)) for i in range(n)]
    rows += [(3, None, "en", "s", 1), (3, None, "en", "s", 1), (None, "x", "en", None, None), (None, "x", None, None, None), (5, "Long A " * 100_000, "fr", "s", 7)]
    got = run(spark, tmp_dir, rows, "a")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in got.collect()), key=str)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("rows", [[], [(1, "A", "en", "s", 1)], [(i, "A", "en", "s", 1) for i in range(9)], [(1, "a", None, None, None), (2, "b", "x", None, 3)],
                                  [(i, "t", f"lang{i}", "s", 1) for i in range(70)]])
def test_small_forests(spark, tmp_dir, rows):
    got = run(spark, tmp_dir, rows, "b").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_other_fanout_and_fields(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(30)], "id long, v string")
    got = M.verify(df.withColumn("g", F.lit("one")), group="g", order="id", fields=("id", "v"), fanout=3, altered={"v": F.lit("v7")})
    root, _ = climb([H(f"{len(str(i))}:{i}", f"{len(f'v{i}')}:v{i}") for i in range(30)], 3)
    got = got.collect()
    assert {r["root"] for r in got} == {root} and [r["id"] for r in got if r["verified"]] == [7]
