from lakecheck.llm import language_id, mixing, quality_rules, toxicity

ROWS = [(1, "the cat and the dog are here"), (2, None), (3, ""), (4, " \t\n"), (5, "12 34 !!"), (6, "der Hund und die Katze"), (7, "я"), (None, "the the"),
        (1, "the cat and the dog are here")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, feature string, n_words int")


def test_language(spark):
    train = spark.createDataFrame([("the cat and the dog are here now", "en"), ("der Hund und die Katze sind da", "de"), (None, "fr"), ("x", None)] * 5, "text string, lang string")
    got = sorted(((r[0] or 0, r[1], r[2]) for r in language_id.identify(frame(spark), train, size=4096).collect()))
    pred = {i: p for i, p, _ in got}
    assert len(got) == len(ROWS) and all(0 <= s <= 1 for _, _, s in got)
    assert (pred[1], pred[6]) == ("en", "de") and all(pred[i] == "und" for i in (2, 3, 4, 5)) and pred[7] in ("en", "de")
    assert {r[1] for r in language_id.identify(frame(spark), train.limit(0)).collect()} == {"und"}


def test_toxicity_both_paths_and_no_labels(spark):
    docs = [(i, f"w{'abcdefgh'[i % 8]} calm words {'vile ' * 2 if i % 4 == 0 else ''}here") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in docs] + [(1, None), (None, 1)], "doc_id long, toxic int")
    df = frame(spark, docs + ROWS[1:5])
    a = toxicity.score(df, labels, min_types=1).collect()
    b = toxicity.score(df, labels, min_types=1, model_rows=0).collect()
    assert sorted((r[0], round(r[1], 9)) for r in a if r[0] > 4) == sorted((r[0], round(r[1], 9)) for r in b if r[0] > 4)
    assert all((r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in a if r["doc_id"] > 4)
    assert {r["score"] for r in toxicity.score(df, labels.limit(0)).collect()} == {0.0}


def test_quality_and_mixing(spark):
    q = quality_rules.judge(frame(spark)).collect()
    assert len(q) == len(ROWS) and all(r["base_failed"] and not r["kept"] for r in q)
    assert {r["n_words"] for r in q if r["doc_id"] in (2, 3, 4)} == {0}
    assert quality_rules.judge(frame(spark).limit(0)).collect() == []
    d = mixing.features(spark.createDataFrame([(i, t, None if i == 5 else "s", "en") for i, t in ROWS], "doc_id long, text string, source string, lang string"))
    m = mixing.calibrate(d).collect()
    assert len(m) == len(ROWS) and all(r["copies"] >= 0 and 0 <= r["probability"] <= 1 for r in m)
    assert {r["factor"] for r in m if r["n_tokens"] == 0} <= {r["factor"] for r in m}
    assert mixing.calibrate(d.limit(0)).collect() == []
