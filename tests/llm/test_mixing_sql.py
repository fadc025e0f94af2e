"""The mixing query against its DuckDB SQL on tables with values that no target lists."""

import random

import duckdb
import pytest

from lakecheck.llm import oracle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(langs, sources, n=1500):
    r = random.Random(9)
    mark = ["", " license", " a@b.c", " a | b"]
    out = [(i, " ".join(f"w{r.randrange(50)}" for _ in range(r.randrange(0, 40))) + r.choices(mark, (8, 1, 1, 1))[0], r.choice(langs), r.choice(sources), 1) for i in range(n)]
    return out + [(5000, None, langs[0], sources[0], 0), (5001, "", None, None, 0), (None, "no id here", langs[-1], sources[0], 1)]


@pytest.mark.parametrize("langs,sources", [(["en", "de", "fr", "es"], ["a", "b"]), (["en", "de", None, "it", "pt"], ["a", None, "c"]), ([None, "it"], [None])])
def test_unlisted_values(spark, tmp_dir, langs, sources):
    spark.createDataFrame(rows(langs, sources), SCHEMA).write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.op10_mixing(spark, tmp_dir)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_dir.removeprefix('file:')}/documents.parquet/*.parquet')")
    rel = con.sql(oracle.oracle_sql()["op10_mixing"])
    names = sorted(got.columns)
    assert names == sorted(rel.columns)
    order = lambda table, cols: sorted(([r[cols.index(c)] for c in names] for r in table), key=str)
    mine, sql = order([tuple(r) for r in got.collect()], got.columns), order(rel.fetchall(), rel.columns)
    assert len(mine) == len(sql)
    for a, b in zip(mine, sql):
        assert a == [
            pytest.approx(y, abs=2e-6) if isinstance(y, float) else y for y in b]
