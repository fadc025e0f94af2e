import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from lakecheck.llm import best_fit_packing as B
from lakecheck.llm import token_counts as T


def docs(n=150):
    r = random.Random(5)
    out = [(i, " ".join(r.choice(["the", "ünder", "Straße", "42", "x!?", "\n", "  "]) for _ in range(r.choice([1, 5, 60, 700, 3000])))) for i in range(n)]
    return out + [(900, None), (901, ""), (902, "<|endoftext|> a <|endoftext|>"), (903, "a" * 5000), (904, out[0][1]), (904, out[0][1])]


def test_pack_round_trip(spark):
    data = docs()
    df = spark.createDataFrame([(i, t, 3) for i, t in data], "doc_id long, text string, offset int")
    got = B.pack(df).collect()
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], dtype="<u4") for i, x in data}
    by = {}
    for r in got:
        x = ids[r["doc_id"]]
        assert zlib.crc32(x[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = sorted((i, k) for i, _ in data for k in range(-(-len(ids[i]) // 1024)))
    assert sorted((r["doc_id"], r["piece"]) for r in got) == want
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert len(by) <= -(-total // 1024) + 1


@pytest.mark.parametrize("cap", [B.Capacity(100), B.Capacity(100, None, None), B.Capacity(100, 3), B.Capacity(100, 5, 4000), B.Capacity(100, 4, 4000, rule="dot")])
def test_plan_keeps_every_constraint(cap):
    r = random.Random(1)
    hist = {n: r.randrange(1, 40) for n in r.sample(range(1, 60), 30)}
    rows, bins = B.plan(hist, cap)
    seq = {}
    for n, a, b, at, off in rows:
        for k in range(a, b):
            seq.setdefault(at + k - a, []).append((off, n))
    assert len(seq) == bins
    assert {n: sum(x[1] == n for p in seq.values() for x in p) for n in hist} == hist
    for p in seq.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:i]) for i in range(len(p))]
        assert sum(n for _, n in p) <= 100 and len(p) <= (cap.documents or 10**9) and sum(n * n for _, n in p) <= (cap.cost or 10**9)


def test_counts_round_trip(spark):
    data = docs(80)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    want = sorted((i, len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in data)
    for block in (7, 1000, 1 << 16):
        assert sorted((r[0], r[1]) for r in T.document_counts(df, block=block).collect()) == want


def test_scan_edges_and_files(spark, tmp_path):
    stream = {0: [9, 9, 1, 0, 5], 1: [3, 4, 5, 6, 7], 2: [9], 3: [1, 9]}
    rows = [(s, k // 2, np.array(x[k:k + 2], dtype="<u2").tobytes()) for s, x in stream.items() for k in range(0, len(x), 2)]
    got = T.count_documents(spark.createDataFrame([*rows, (3, 9, b"")], "shard int, block long, ids binary"), separator=9)
    want = {(0, 0, 0, True), (0, 1, 0, True), (0, 2, 3, False), (1, 0, 5, False), (2, 0, 0, True), (3, 0, 1, True)}
    assert {tuple(r) for r in got.collect()} == want
    for s, x in stream.items():
        np.array(x, dtype="<u2").tofile(tmp_path / f"{s}.bin")
    files = T.read_files(spark, str(tmp_path), block=2)
    assert {tuple(r) for r in T.count_documents(files, separator=9).collect()} == want
    assert T.count_documents(files.limit(0)).collect() == []
    assert B.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_runs_of_blanks(spark):
    """Texts that the fast encoder refuses: a megabyte of spaces, and of newlines."""
    rows = [(1, " " * 1_000_000), (2, "\n" * 1_000_000), (3, "a word"), (4, "x" + " " * 300_000 + "<|endoftext|>")]
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    want = {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in rows}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in T.document_counts(df).collect()} == want
    t.encode_special_tokens = False
    total = {}
    for r in B.pack(df).collect():
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in rows}


def test_no_documents(spark):
    assert T.document_counts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_the_rule_weighs_all_capacities():
    """Of bins with equal tokens left, the one whose documents fit better is taken."""
    cap = B.Capacity(10, 4, None, weights=(1.0, 1.0, 0.0))
    rows, bins = B.plan({8: 1, 4: 2, 2: 1}, cap)                      # 8 | 4 4: both have 2 tokens left, 3 or 2 documents
    assert bins == 2 and [at for n, _, _, at, _ in rows if n == 2] == [at for n, _, _, at, _ in rows if n == 4][:1]
