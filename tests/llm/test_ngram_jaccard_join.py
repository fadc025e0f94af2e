import random

import pytest

from lakecheck.llm import ngram_jaccard_join as J
import brute


def rows(seed, n=160, vocab=400):
    r = random.Random(seed)
    base = [[f"w{r.randrange(vocab)}" for _ in range(r.choice([3, 8, 15, 40, 90]))] for _ in range(n // 4)]
    passage = [f"p{i}" for i in range(30)]
    out = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 4])):
            k = r.randrange(len(w))
            w[k:k + 1] = r.choice([[], ["x"], [f"w{r.randrange(vocab)}"], [w[k].upper()]])
            w = w or ["a"]
        if r.random() < 0.2:
            w += passage
        out.append((i, " ".join(w)))
    return out + [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, out[0][1]), (906, out[0][1])]


@pytest.mark.parametrize("seed,words,num,limit", [(1, 4, 85, 32), (2, 5, 80, 1), (3, 2, 60, 1), (4, 1, 85, 2)])
def test_against_brute_force(spark, seed, words, num, limit):
    data = rows(seed)
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in data], "doc_id long, text string, id string, n long")
    got = J.jaccard_classes(df, words=words, num=num, max_classes=limit).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute.jaccard_classes(data, words, num, 100)
    assert len(got) == len(data)


def test_empty_table_null_and_repeated_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert J.jaccard_classes(empty).collect() == []
    df = spark.createDataFrame([(None, "a b"), (1, "a b c d e f"), (1, "g h"), (2, "a b c d e f")], "doc_id long, text string")
    assert {tuple(r) for r in J.jaccard_classes(df).collect()} == {(1, 2, 1), (2, 2, 1)}


def thue_morse(n, a, b):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


def test_words_that_polynomial_hashes_confuse(spark):
    """A Thue-Morse word and its complement collide under any polynomial modulo 2**64; their documents are not linked."""
    rows = [(i, thue_morse(n, *ab)) for i, (n, ab) in enumerate([(m, x) for m in (128, 1024, 2048, 4096) for x in ("ab", "ba")])]
    rows += [(10, " ".join(f"w{i}" for i in range(30)) + " " + thue_morse(2048, "x", "y")), (11, " ".join(f"w{i}" for i in range(30)) + " " + thue_morse(2048, "y", "x")),
             (12, thue_morse(2048, "A", "B"))]
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), words=4, num=85, den=100).collect()}
    assert got == {i: c for i, (_, c) in brute.jaccard_classes(rows, 4, 85, 100).items()}
    assert len({got[i] for i in range(8)}) == 8 and got[12] == 4
