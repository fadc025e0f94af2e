import hashlib
import random

import xxhash

import brute
import corpus_pipeline as P
from lakecheck.llm import mixing
from lakecheck.sources.tables import load
from test_suffix_dedup import brute as without_repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    """(rows of documents, ids of toxic ones): toxic expressions, copies, near copies, a shared passage and edge cases."""
    r = random.Random(3)
    vocab = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(3, 9))) for _ in range(400)]
    texts, toxic = {}, set()
    for i in range(240):
        w = [r.choice(vocab) for _ in range(r.randrange(60, 120))]
        if i % 6 == 0:
            toxic.add(i)
            for _ in range(5):
                w.insert(r.randrange(1, len(w)), "vile")
        texts[i] = " ".join(w)
    passage = " ".join(r.choice(vocab) for _ in range(60))
    for i in (1, 7, 13, 19):
        texts[i] += " " + passage
    for k, i in enumerate((2, 3, 4, 5, 8, 9)):
        w = texts[i].split(" ")
        texts[300 + k], texts[310 + k] = texts[i], " ".join(w[:-1] + [f"other{k}"])
    texts |= {400: None, 401: "", 402: " \n", 403: "one", 404: "mail a@b.c now"}
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["web", "books"]), len(t or "")) for i, t in texts.items()]
    more = [rows[10], (None, "a row without an id", "en", "web", 19), (None, texts[14], "en", "web", 5), (21, texts[22], None, "books", 7),
            (None, texts[15] + " " + passage, None, "web", 9), (402, " \n", "en", "web", 2), (None, "", "en", "web", 0)]
    return rows + more, toxic


def near_copies(rows):
    """Rows that the near-duplicate stage keeps: of each class the first by id (NULL last), hash of the text and the rest."""
    def first(x):
        h = xxhash.xxh64_intdigest(x[1].encode(), 42) if x[1] is not None else 42
        return x[0] is None, x[0] or 0, h - (h >> 63 << 64), *[(v is not None, v or 0) for v in x[2:]]
    order = sorted(rows, key=first)
    classes = brute.jaccard_classes([(k, x[1]) for k, x in enumerate(order)], 5, 80, 100)
    out, bare = [], set()
    for k, x in enumerate(order):
        if classes[k][1] == k and (x[0] is None or brute.words(x[1]) or (x[0], x[1]) not in bare):
            out.append(x)
            bare.add((x[0], x[1]))
    return out


def raked(cells, targets, sweeps=mixing.SWEEPS):
    """Factor of each cell {(value, ...): weight} after plain proportional fitting; values not listed keep their share."""
    total, now = sum(cells.values()), {c: float(m) for c, m in cells.items() if m}
    goal = []
    for k, t in enumerate(targets.values()):
        sums = {}
        for c, m in cells.items():
            if m:
                sums[c[k]] = sums.get(c[k], 0) + m
        listed = {v: t[v] if isinstance(t, dict) else m ** t for v, m in sums.items() if not isinstance(t, dict) or v in t}
        norm, other = sum(listed.values()), sum(m for v, m in sums.items() if v not in listed)
        whole = total if norm else other
        goal.append({v: listed[v] / (norm or 1) * (1 - other / whole) if v in listed else m / whole for v, m in sums.items()})
    for _ in range(sweeps):
        for k, g in enumerate(goal):
            sums = {}
            for c, m in now.items():
                sums[c[k]] = sums.get(c[k], 0) + m
            now = {c: m * total * g[c[k]] / sums[c[k]] if sums[c[k]] else 0.0 for c, m in now.items()}
    return {c: round(now[c] / m, 9) if m else 1.0 for c, m in cells.items()}


def drawn(rows):
    """Rows that the mixing stage returns, each as often as its factor and draw say."""
    def topic(t):
        t = t or ""
        return ("legal" if "icense" in t or "rights reserved" in t else "contact" if "@" in t else "listing" if " | " in t else "prose")
    of = lambda x: (x[3], x[2], topic(x[1]))
    cells = {}
    for x in rows:
        cells[of(x)] = cells.get(of(x), 0) + len(brute.words(x[1]))
    factor, out = raked(cells, mixing.TARGETS), []
    for x in rows:
        name = x[0] if x[0] is not None else hashlib.md5(x[1].encode()).hexdigest()
        u, f = int(hashlib.md5(f"{name}:0".encode()).hexdigest()[:8], 16) / 2 ** 32, factor[of(x)]
        out += [x] * (int(f) + (u < f - int(f)))
    return out


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def test_every_stage_against_brute_force(spark, tmp_dir):
    rows, toxic = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(i, int(i in toxic), 1) for i, *_ in rows if i is not None], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_dir}/labels.parquet")
    docs, results = load(spark, tmp_dir, "documents"), []
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "mixing", "packing"]
    for k, (name, stage) in enumerate(P.STAGES):
        docs_out = stage(spark, docs, tmp_dir)
        if k < 4:
            assert docs_out.columns == docs.columns
            docs_out.write.parquet(f"{tmp_dir}/{name}")
            docs = spark.read.parquet(f"{tmp_dir}/{name}")
            results.append(sorted((tuple(r) for r in docs.collect()), key=key))
    assert results[0] == sorted((x for x in rows if x[0] not in toxic), key=key)
    assert results[1] == sorted(near_copies(results[0]), key=key)
    assert len(results[1]) < len(results[0])
    cut = without_repeats([(k, t) for k, (_, t, *_) in enumerate(results[1])], 200)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted((str(x[0]), x[2] or "", x[3], sha(x[1])) for x in results[2]) == sorted(
        (str(x[0]), x[2] or "", x[3], cut[k][3]) for k, x in enumerate(results[1]))
    assert all(x[4] == len(x[1] or "") for x in results[2]) and any(cut[k][1] for k in cut)
    assert results[3] == sorted(drawn(results[2]), key=key)
    assert len(set(results[3])) < len(results[3]) and {x[2] for x in results[3]} == {"en", "de", None}
    digest = lambda df: sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect()), key=str)
    last = docs_out.collect()
    assert {r["doc_id"] for r in last} == {x[0] for x in results[3]}
    by = {}
    for r in last:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 1024
    assert digest(P.run(spark, tmp_dir)) == digest(docs_out)


def test_empty_tables(spark, tmp_dir):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_dir}/labels.parquet")
    assert P.run(spark, tmp_dir).collect() == []
