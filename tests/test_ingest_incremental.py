"""Ledger of loaded files, and rejects."""

import os
import time

from pyspark.sql import types as T

from lakecheck.sources import ledger, rejects

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType()), T.StructField("d", T.DateType()), T.StructField("s", T.StringType())])


def local(path):
    return path.removeprefix("file:")


def put(base, name, text):
    os.makedirs(local(base), exist_ok=True)
    with open(f"{local(base)}/{name}", "w") as f:
        f.write(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_loads_new_files_only(spark, tmp_dir):
    base, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    put(base, "a.csv", "k,v,d,s\n1,1.5,2025-01-01,x\n2,2.5,2025-01-02,y\n")
    put(base, "notes.txt", "not a table")
    assert ledger.ingest_new(spark, base, out, SCHEMA) == {"files": 1, "load": 1}
    assert ledger.ingest_new(spark, base, out, SCHEMA) == {"files": 0, "load": 0}
    put(base, "b.csv", "k,v,d,s\n3,,,z\n")
    put(base, "c.csv", "k,v,d,s\n")
    assert ledger.ingest_new(spark, base, out, SCHEMA) == {"files": 2, "load": 2}
    assert [(r["k"], r["_load"]) for r in ledger.read(spark, out).orderBy("k").collect()] == [(1, 1), (2, 1), (3, 2)]
    # a file that was rewritten is loaded again in place of its earlier rows
    time.sleep(1.1)
    put(base, "a.csv", "k,v,d,s\n1,9.5,2025-01-01,new\n")
    assert ledger.ingest_new(spark, base, out, SCHEMA) == {"files": 1, "load": 3}
    assert [(r["k"], r["s"], r["_load"]) for r in ledger.read(spark, out).orderBy("k").collect()] == [(1, "new", 3), (3, "z", 2)]


def test_a_load_that_died_is_not_seen_and_is_repeated(spark, tmp_dir, monkeypatch):
    base, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    put(base, "a.csv", "k,v,d,s\n1,1.5,2025-01-01,x\n")
    ledger.ingest_new(spark, base, out, SCHEMA)
    put(base, "b.csv", "k,v,d,s\n2,1.5,2025-01-01,y\n")
    write, calls = ledger.runs.write_run, []

    def once(df, path, *more):
        calls.append(path)
        if path.endswith("/ledger"):
            raise RuntimeError("stopped")
        write(df, path, *more)
    with monkeypatch.context() as m:
        m.setattr(ledger.runs, "write_run", once)
        try:
            ledger.ingest_new(spark, base, out, SCHEMA)
        except RuntimeError:
            pass
    assert len(calls) == 2 and [r["k"] for r in ledger.read(spark, out).collect()] == [1]
    assert ledger.ingest_new(spark, base, out, SCHEMA) == {"files": 1, "load": 2}
    assert rows(ledger.read(spark, out).select("k", "_load")) == [(1, 1), (2, 2)]


def test_rejects_and_typed_rows(spark, tmp_dir):
    put(tmp_dir, "a.csv", 'k,v,d,s\n1,1.5,2025-01-01,x\n2,abc,2025-13-01,y\n3,1\n4,1.0,2025-01-01,z,extra\n99999999999999999999,,,\n 5 , 2.0 ,2025-01-03,"q,r"\n')
    text = rejects.read_text(spark, tmp_dir, SCHEMA)
    assert rows(rejects.typed(text, SCHEMA).select("k", "v", "s")) == sorted(
        [(1, 1.5, "x"), (2, None, "y"), (None, None, None), (5, 2.0, "q,r")], key=str)
    assert rows(rejects.rejects(text, SCHEMA)) == sorted([
        ("a.csv", "cast", "v", "abc"), ("a.csv", "cast", "d", "2025-13-01"), ("a.csv", "cast", "k", "99999999999999999999"),
        ("a.csv", "malformed", None, "3,1"), ("a.csv", "malformed", None, "4,1.0,2025-01-01,z,extra")], key=str)
    assert rows(rejects.profile(rejects.rejects(text, SCHEMA)))[-1][2] == 2


def test_header_is_checked(spark, tmp_dir):
    put(tmp_dir, "a.csv", "v,k,d,s\n1,2,3,4\n")
    try:
        rejects.read_text(spark, tmp_dir, SCHEMA).collect()
        raise AssertionError("a header in another order was read")
    except Exception as e:
        assert "header" in str(e).lower()
