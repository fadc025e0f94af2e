"""Language identification against plain Python: exact sets in place of the filter, popcounts and the correction."""

import random

import numpy as np
import pytest

from lakecheck.llm import language_id as L

SPACE = ord(" ")


def folded(text):
    """Letters lower-cased (A-Z and U+00C0-U+00DE), other ASCII a space, one space at either end."""
    out = bytearray()
    for c in text:
        if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×"):
            c = c.lower()
        elif ord(c) < 128 and not "a" <= c <= "z":
            c = " "
        out += c.encode()
    return b" " + bytes(out) + b" "


def plain_grams(text):
    b = folded(text or "")
    return [b[i:i + 4] for i in range(len(b) - 3) if b[i:i + 4] != b"    "]


def plain_fit(train, share):
    n = {}
    for text, lang in train:
        if text is not None and lang is not None:
            for g in plain_grams(text):
                n.setdefault(lang, {}).setdefault(g, 0)
                n[lang][g] += 1
    total = {x: sum(c.values()) for x, c in n.items()}
    langs, of = sorted(total, key=lambda x: (-total[x], x)), {}
    for g in {g for c in n.values() for g in c}:
        rate = {x: c[g] / total[x] for x, c in n.items() if g in c}
        of[g] = {x for x, r in rate.items() if r >= share * max(rate.values())}
    return langs, of


def plain_judge(text, langs, of):
    if not any(c.isalpha() for c in text or "") or not langs:
        return "und", 0.0
    hits = [sum(x in of.get(g, ()) for g in plain_grams(text)) for x in langs]
    best = max(range(len(langs)), key=lambda i: hits[i])
    return langs[best], hits[best] / sum(hits) if sum(hits) else 0.0


def corpus(n_langs, n=12, seed=6):
    r = random.Random(seed)
    words = {f"l{x:03d}": ["".join(r.choice("abcdefghijklmnopqrstuvwxyzéüß") for _ in range(r.randrange(3, 8))) for _ in range(30)] for x in range(n_langs)}
    shared = ["data", "Über", "42", "x-y"]
    text = lambda x, k: " ".join(r.choice(words[x] + shared) for _ in range(k))
    train = [(text(x, 20), x) for x in words for _ in range(n)]
    docs = [(i, text(x, r.randrange(3, 25)), x) for i, x in enumerate(sorted(words) * 2)]
    return train, docs


@pytest.mark.parametrize("n_langs,share", [(3, L.SHARE), (5, 0.0), (130, L.SHARE)])
def test_against_plain_python(spark, n_langs, share):
    train, docs = corpus(n_langs, 4 if n_langs > 100 else 12)
    rows = [(i, t) for i, t, _ in docs] + [(9000, None), (9001, "12 34"), (9002, "zzzz qqqq"), (9003, "ÀÉ " + docs[0][1]), (None, docs[0][1]), (9004, docs[0][1] + " " + "x1 " * 200_000)]
    langs, of = plain_fit(train, share)
    got = L.identify(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(train, "text string, lang string"), size=1 << 18, share=share)
    got = sorted(((r[0], r[1], r[2]) for r in got.collect()), key=str)
    want = sorted(((i, *plain_judge(t, langs, of)) for i, t in rows), key=str)
    assert [g[0] for g in got] == [w[0] for w in want]
    for g, w in zip(got, want):
        # the filter's false positives, after correction, move a score by little; ties may fall either way
        assert abs(g[2] - w[2]) < 0.02 and (g[1] == w[1] or w[2] < 0.5)


def test_one_training_text_teaches_all_its_grams(spark):
    train = [("the cat and the dog are here", "en")] * 5 + [("le chat dort bien", "fr")]
    got = L.identify(spark.createDataFrame([(1, "le chat dort bien")], "doc_id long, text string"), spark.createDataFrame(train, "text string, lang string"), size=1 << 16).collect()
    assert got[0]["lang_pred"] == "fr" and got[0]["score"] > 0.9


def test_filter_returns_all_languages_and_its_errors_are_corrected(spark):
    train, _ = corpus(70, 2)
    langs, of = plain_fit(train, L.SHARE)
    names, table = L.fit(spark.createDataFrame(train, "text string, lang string"), size=1 << 15)
    assert names == langs and table.shape == (2, 1 << 15)
    code = np.array([int.from_bytes(g, "big") for g in of], dtype=np.uint32)
    mask = L.languages_of(code, table, L.HASHES)
    for i, x in enumerate(langs):
        assert all(L.has(mask, i)[k] for k, g in enumerate(of) if x in of[g])          # a Bloom filter misses nothing
    # of n-grams that no language has, each language claims about its rate; the correction takes that away
    strange = np.arange(1, 200_001, dtype=np.uint32) | np.uint32(0xF0000000)
    hits = np.array([[L.has(L.languages_of(strange, table, L.HASHES), i).sum()] for i in range(len(langs))])
    fp = np.array([float(L.has(table, i).mean()) ** L.HASHES for i in range(len(langs))])
    right = L.corrected(hits, np.array([len(strange)]), fp)
    assert (hits > 0).any() and (right <= 0.25 * hits.max() + 40).all()


def test_empty_documents(spark):
    train = spark.createDataFrame([("the cat", "en")], "text string, lang string")
    assert L.identify(spark.createDataFrame([], "doc_id long, text string"), train, size=1 << 12).collect() == []


def test_null_ids_are_not_held_out(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(None,), (1,), (6,)], "doc_id long")
    assert {r[0] for r in df.where("doc_id is null").select(L.held_out(F.col("doc_id"), 4, 2)).collect()} == {False}
