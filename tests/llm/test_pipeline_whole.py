"""Stages of the corpus pipeline that must do the whole job: shares, values without a target, repeated and NULL ids."""

import random

import pytest

import brute
import corpus_pipeline as P
from lakecheck.llm import mixing, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
MARK = {"legal": "license", "contact": "a@b.c", "listing": "a | b", "prose": "plain"}


def skewed(n=6000, langs=("en", "de", "fr", "es"), weights=(90, 4, 3, 3)):
    r = random.Random(7)
    out = []
    for i in range(n):
        topic = r.choices(list(MARK), (5, 1, 4, 90))[0]
        text = " ".join([f"w{r.randrange(1000)}" for _ in range(r.randrange(10, 30))] + [MARK[topic]])
        out.append((i, text, r.choices(langs, weights)[0], r.choices(("web", "books", "code"), (80, 15, 5))[0], len(text)))
    return out


def shares(rows, of):
    sums = {}
    for x in rows:
        sums[of(x)] = sums.get(of(x), 0) + len(brute.words(x[1]))
    return {k: v / sum(sums.values()) for k, v in sums.items()}


def topic_of(x):
    return next(t for t, m in MARK.items() if m in x[1])


def test_mixing_meets_the_targets(spark):
    rows = skewed()
    stage = P.mix_sources(spark, spark.createDataFrame(rows, SCHEMA), "")
    kept = [tuple(r) for r in stage.collect()]
    assert stage.columns == [c.split(" ")[0] for c in SCHEMA.split(", ")] and set(kept) <= set(rows)
    before = shares(rows, lambda x: x[3])
    root = {s: v ** mixing.TARGETS["source"] for s, v in before.items()}
    for of, want in ((lambda x: x[2], mixing.TARGETS["lang"]), (topic_of, mixing.TARGETS["topic"]),
                     (lambda x: x[3], {s: v / sum(root.values()) for s, v in root.items()})):
        got = shares(kept, of)
        assert all(got[v] == pytest.approx(share, abs=0.02) for v, share in want.items())
    times = {}
    for x in kept:
        times[x] = times.get(x, 0) + 1
    assert max(times.values()) > 1


def test_rows_are_repeated_as_copies_say(spark):
    n = [0, 1, 2, mixing.COPY_BLOCK, mixing.COPY_BLOCK + 1, 3 * mixing.COPY_BLOCK]
    out = mixing.repeat(spark.createDataFrame([(i, k) for i, k in enumerate(n)], "doc_id long, copies long"))
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == {i: k for i, k in enumerate(n) if k}


def test_values_without_a_target_keep_their_share(spark):
    langs = ("en", "de", "fr", "es", None, "it")
    rows = skewed(n=8000, langs=langs, weights=(60, 4, 3, 3, 20, 10))
    before = shares(rows, lambda x: x[2])
    got = shares([tuple(r) for r in P.mix_sources(spark, spark.createDataFrame(rows, SCHEMA), "").collect()], lambda x: x[2])
    rest = 1 - before[None] - before["it"]
    want = {v: mixing.TARGETS["lang"][v] * rest if v in mixing.TARGETS["lang"] else before[v] for v in langs}
    assert all(got[v] == pytest.approx(want[v], abs=0.02) for v in langs)


def test_only_values_without_a_target(spark):
    rows = skewed(n=300, langs=(None, "it"), weights=(1, 1))
    got = mixing.calibrate(mixing.features(spark.createDataFrame(rows, SCHEMA)), {"lang": mixing.TARGETS["lang"]}).collect()
    assert len(got) == 300 and all(r["factor"] == pytest.approx(1.0) and r["copies"] >= 1 for r in got if r["n_tokens"])
    none = mixing.calibrate(mixing.features(spark.createDataFrame(rows, SCHEMA)), {"lang": {"it": 0.0}}).collect()
    assert all(r["factor"] == 0.0 for r in none if r["lang"]) and sum(r["factor"] * r["n_tokens"] for r in none) == pytest.approx(
        sum(r["n_tokens"] for r in none))


def test_toxicity_weighs_the_whole_text(spark):
    r = random.Random(5)
    plain = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    docs = []
    for i in range(600):
        w = r.choices(plain, k=r.randrange(20, 60))
        if i % 4 == 0:
            w += r.choices(["vile", "foul", "dire"], k=3) + ["xa", "seldom"]      # seldom always follows the same word
        docs.append((i, " ".join(w)))
    calm = " ".join(r.choices(plain, k=30))
    asked = {900: "vile " + calm, 901: "vile " + " ".join([calm] * 10), 902: calm, 903: calm + " xa seldom", 904: calm + " vile foul dire", 905: "", 906: None}
    df = spark.createDataFrame(docs + list(asked.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in docs], "doc_id long, toxic int")
    got, shuffled = ({x["doc_id"]: x for x in toxicity.score(df, labels, **more).collect()} for more in ({}, {"model_rows": 0}))
    f = {i: got[i]["feature"] for i in asked}
    assert f[900] > f[901] > f[902] and f[904] > f[900]             # falls as clean text is added, rises with every toxic word
    assert f[903] > f[902] and got[903]["peak"] > got[902]["peak"]  # a rare word counts
    assert got[900]["score"] > got[901]["score"]
    assert f[905] == f[906] == 0.0
    for i, x in got.items():
        assert all(shuffled[i][c] == pytest.approx(x[c], abs=1e-9) for c in ("score", "feature", "peak"))


def test_repeated_and_null_ids_are_documents(spark):
    r = random.Random(11)
    text = lambda n=60: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    a, b, c, d, passage = text(), text(), text(), text(), text(50)
    rows = [(1, a), (1, a), (2, b), (2, c), (3, b), (None, c), (None, d), (None, d), (4, text() + " " + passage), (4, text() + " " + passage),
            (5, None), (5, None), (5, ""), (6, ""), (None, ""), (None, None)]
    rows = [(i, t, "en", "web", len(t or "")) for i, t in rows]
    key = lambda x: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in x)
    kept = sorted((tuple(x) for x in P.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect()), key=key)
    want = [rows[k] for k in (0, 2, 3, 6, 8, 9, 10, 12, 13, 14, 15)]
    assert kept == sorted(want, key=key)
    out = [tuple(x) for x in P.cut_passages(spark, spark.createDataFrame(kept, SCHEMA), "").collect()]
    assert sorted((x[0] is None, x[0] or 0) for x in out) == sorted((x[0] is None, x[0] or 0) for x in kept)
    whole = {x[1] for x in kept if x[0] != 4}
    assert {x[1] or None for x in out if x[0] != 4} == {t or None for t in whole}       # one row of each text: nothing is cut
    assert sorted(x[1] for x in out if x[0] == 4) == sorted(x[1][:-len(passage) - 1] for x in kept if x[0] == 4)


def test_passages_are_cut_by_row(spark):
    r = random.Random(12)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    passage = text(40)
    rows = [(1, text(30) + passage), (1, passage + text(20)), (1, text(40)), (None, text(20) + passage + text(25)), (None, text(50)), (2, "x")]
    got = suffix_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(x["kept_text"] for x in got) == sorted(t.replace(passage, "") for _, t in rows)
    assert sorted(str(x["doc_id"]) for x in got) == sorted(str(i) for i, _ in rows)


def test_toxic_rows_without_id_go(spark, tmp_dir):
    docs = [(i, f"word{'abcdefgh'[i % 8]} calm plain {'vile vile ' if i % 4 == 0 else ''}here", "en", "web", 1) for i in range(400)]
    more = [(None, "calm vile vile plain here", "en", "web", 1), (None, "calm plain here", "en", "web", 1), (1, "plain vile vile vile calm", "en", "web", 1)]
    spark.createDataFrame([(i, int(i % 4 == 0), 1) for i, *_ in docs if i != 1], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_dir}/labels.parquet")
    got = {(x[0], x[1]) for x in P.drop_toxic(spark, spark.createDataFrame(docs + more, SCHEMA), tmp_dir).collect()}
    assert got == {(i, t) for i, t, *_ in docs if i % 4} | {(None, "calm plain here")}


def test_other_columns_are_carried(spark, tmp_dir):
    """Columns that are not of ``documents`` come out as they came in, whatever their names; texts may be very long."""
    r = random.Random(4)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    more = ("__row", "n_tokens", "topic", "row", "doc", "copies", "factor", "class", "place", "draw", "score", "id", "text_hash")
    rows = [(i, text(40), "en", "web", 1, *[f"{c}{i}" for c in more]) for i in range(12)]
    rows += [(20, text(60_000), "en", "web", 1, *["long"] * len(more)), (21, rows[3][1], "en", "web", 1, *["copy"] * len(more))]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", {c} string" for c in more))
    spark.createDataFrame([(0, 0, 1)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_dir}/labels.parquet")
    want = {x for x in rows if x[0] != 21}
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, tmp_dir)
        assert docs.columns == [c.split(" ")[0] for c in SCHEMA.split(", ")] + list(more)
        got = {tuple(x) for x in docs.collect()}
        if name == "toxicity":
            assert got == set(rows)
        else:
            assert {x[:1] + x[5:] for x in got} <= {x[:1] + x[5:] for x in want}
            assert name == "mixing" or {x[:1] + x[5:] for x in got} == {x[:1] + x[5:] for x in want}
        docs = spark.createDataFrame(sorted(got, key=str), docs.schema)
    assert {x["doc_id"] for x in P.pack_sequences(spark, docs, tmp_dir).collect()} <= {x[0] for x in want}
