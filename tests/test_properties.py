"""Property tests against brute force: the compact record diff and the one-aggregate check
log must equal the reference's row-level definitions on random inputs with duplicate keys,
NULL keys and NULL values."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakecheck.operators import recon

SCHEMA = "id int, a int, b string"
SPEC = recon.CheckSpec(key="id", sum_cols=("a",), hash_cols=("id", "a", "b"), compare_cols=("a", "b"),
                       table_name="s -> t")

val = st.one_of(st.none(), st.integers(0, 2))
txt = st.one_of(st.none(), st.sampled_from(["x", "y"]))
rows = st.lists(st.tuples(val, val, txt), max_size=12)


def brute_diff(src, tgt):
    """Full outer join on id (NULL never matches), flagged by NOT (s <=> t) over (a, b)."""
    by_key = defaultdict(list)
    for t in tgt:
        if t[0] is not None:
            by_key[t[0]].append(t)
    src_keys = {s[0] for s in src if s[0] is not None}
    pairs = []
    for s in src:
        ms = by_key.get(s[0]) if s[0] is not None else None
        pairs += [(s, t) for t in ms] if ms else [(s, None)]
    pairs += [(None, t) for t in tgt if t[0] is None or t[0] not in src_keys]
    out = []
    for s, t in pairs:
        sv = s[1:] if s else (None, None)
        tv = t[1:] if t else (None, None)
        if any(x != y for x, y in zip(sv, tv)):
            out.append(((s or t)[0], *sv, *tv))
    return Counter(out)


def brute_compact(src, tgt):
    """The compact diff by its definition: versions per key and side; pairs where one side
    of the key has a single version, each version listed where both sides have several."""
    side = {"s": defaultdict(Counter), "t": defaultdict(Counter)}
    out = Counter()
    for tag, rs in (("s", src), ("t", tgt)):
        for r in rs:
            if r[0] is None:   # NULL keys never match: one-sided
                if any(x is not None for x in r[1:]):
                    out[(None, *r[1:], None, None) if tag == "s" else (None, None, None, *r[1:])] += 1
            else:
                side[tag][r[0]][r[1:]] += 1
    for k in set(side["s"]) | set(side["t"]):
        s, t = side["s"].get(k, Counter()), side["t"].get(k, Counter())
        if s and t and (len(s) == 1 or len(t) == 1):
            for p, a in s.items():
                for q, b in t.items():
                    if p != q:
                        out[(k, *p, *q)] += a * b
            continue
        for p, a in s.items():
            if t or any(x is not None for x in p):
                out[(k, *p, None, None)] += a
        for q, b in t.items():
            if s or any(x is not None for x in q):
                out[(k, None, None, *q)] += b
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(src=rows, tgt=rows)
def test_record_diff_equals_brute_force(spark, src, tgt):
    s, t = spark.createDataFrame(src, SCHEMA), spark.createDataFrame(tgt, SCHEMA)
    compact = recon.record_diff(s, t, "id", ["a", "b"])
    got = Counter()
    for r in compact.collect():
        got[tuple(r)[:-1]] += r.n_rows
    assert got == brute_compact(src, tgt)
    want = brute_diff(src, tgt)
    many = any(len({r[1:] for r in src if r[0] == k}) > 1 and len({r[1:] for r in tgt if r[0] == k}) > 1
               for k in {r[0] for r in src if r[0] is not None})
    if not many:   # without many-to-many keys the compact rows expand to the reference's rows
        assert Counter(tuple(r) for r in recon.expand_diff(compact).collect()) == want
    checks = {r.check_type: r for r in recon.run_checks(s, t, SPEC, "r", "2025-01-01 00:00:00").collect()}
    assert checks["RECORD_DIFF"].mismatch_count == sum(want.values())
    assert checks["ROW_COUNT"].mismatch_count == abs(len(src) - len(tgt))
    ssum = sum(r[1] for r in src if r[1] is not None)
    assert checks["COLUMN_SUM"].source_value == f"{ssum:.2f}"
    fp = lambda df: recon.fingerprint(df, ["id", "a", "b"]).first()[0]
    assert checks["COLUMN_HASH"].source_value == (None if not src else str(fp(s)))


# ---------------------------------------------------------------- SCD2 and numbering

import datetime as dt  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from lakecheck.operators import dims  # noqa: E402
from lakecheck.operators.numbering import number_rows  # noqa: E402

AS_OF = dt.date(2025, 6, 1)
attr = st.one_of(st.none(), st.sampled_from(["p", "q"]))
dim_rows = st.lists(st.tuples(st.integers(0, 8), attr), max_size=8, unique_by=lambda r: r[0])


def brute_scd2(dim, incoming, null_safe):
    """dim: list of (id, a, sk, eff, end, cur); reference UPDATE-then-append semantics."""
    cur = {r[0]: r for r in dim if r[5]}
    def changed(x, y):
        return (x != y) if null_safe else (x is not None and y is not None and x != y)
    changes = [r for r in incoming if r[0] not in cur or changed(r[1], cur[r[0]][1])]
    keys = {r[0] for r in changes}
    out = [(i, a, sk, eff, AS_OF if (c and i in keys) else end, False if (c and i in keys) else c)
           for i, a, sk, eff, end, c in dim]
    top = max((r[2] for r in dim), default=0)
    out += [(i, a, top + n + 1, AS_OF, None, True) for n, (i, a) in enumerate(sorted(changes))]
    return sorted(out, key=repr)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=dim_rows, second=dim_rows, null_safe=st.booleans())
def test_scd2_apply_equals_brute_force(spark, first, second, null_safe):
    src = spark.createDataFrame(first, "id int, a string")
    d0 = dims.scd2_init(src, "id", "2025-01-01", buckets=3)
    inc = spark.createDataFrame(second, "id int, a string")
    got = sorted((tuple(r) for r in dims.scd2_apply(d0, inc, "id", ["a"], "2025-06-01",
                                                     null_safe=null_safe, buckets=3).collect()), key=repr)
    d0_rows = [tuple(r) for r in d0.collect()]
    assert got == brute_scd2(d0_rows, second, null_safe)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=st.lists(st.integers(-5, 5), max_size=40), buckets=st.integers(1, 6))
def test_number_rows_is_a_dense_order_preserving_numbering(spark, keys, buckets):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    got = sorted((r.sk, r.k) for r in number_rows(df, ["k"], "sk", offset=10, buckets=buckets).collect())
    assert [s for s, _ in got] == list(range(11, 11 + len(keys)))
    assert [k for _, k in got] == sorted(keys)


def test_number_rows_spreads_a_group_of_copies(spark):
    # one identical row repeated 3000 times plus 1000 distinct rows: dense numbering, and the
    # copies are not all in one range partition
    df = spark.createDataFrame([(0, "x")] * 3000 + [(i, "y") for i in range(1, 1001)], "k int, v string")
    out = number_rows(df, ["k"], "sk", buckets=8)
    got = sorted((r.sk, r.k) for r in out.collect())
    assert [s for s, _ in got] == list(range(1, 4001))
    assert [k for _, k in got] == sorted([0] * 3000 + list(range(1, 1001)))
    per_part = (out.where("k = 0").select(F.spark_partition_id().alias("p")).distinct().count())
    assert per_part > 1


SCHEMA_X = "id int, a int, b string, c int"
SPEC_X = recon.CheckSpec(key="id", sum_cols=("a", "c"), hash_cols=("id", "a", "b", "c"),
                         compare_cols=("a", "b"), table_name="s -> t")
rows_x = st.lists(st.tuples(val, val, txt, st.integers(0, 3)), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(src=rows_x, tgt=rows_x)
def test_checks_with_columns_beyond_the_compared_ones(spark, src, tgt):
    # versions group by (id, a, b, c); the diff count must still follow (id, a, b) only
    s, t = spark.createDataFrame(src, SCHEMA_X), spark.createDataFrame(tgt, SCHEMA_X)
    checks = {(r.check_type, r.metric_name): r for r in
              recon.run_checks(s, t, SPEC_X, "r", "2025-01-01 00:00:00").collect()}
    want = brute_diff([r[:3] for r in src], [r[:3] for r in tgt])
    assert checks[("RECORD_DIFF", "mismatched_rows")].mismatch_count == sum(want.values())
    assert checks[("COLUMN_SUM", "sum_c")].source_value == f"{sum(r[3] for r in src):.2f}"
    assert checks[("ROW_COUNT", "row_count")].target_value == str(len(tgt))


skey = st.one_of(st.none(), st.sampled_from(["", "k1", "k2"]))
rows_s = st.lists(st.tuples(skey, val, txt), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(src=rows_s, tgt=rows_s)
def test_record_diff_with_string_keys(spark, src, tgt):
    # NULL and empty-string keys must stay apart in the null-safe join
    s = spark.createDataFrame(src, "id string, a int, b string")
    t = spark.createDataFrame(tgt, "id string, a int, b string")
    got = Counter()
    for r in recon.record_diff(s, t, "id", ["a", "b"]).collect():
        got[tuple(r)[:-1]] += r.n_rows
    assert got == brute_compact(src, tgt)
    spec = recon.CheckSpec(key="id", sum_cols=("a",), hash_cols=("id", "a", "b"), compare_cols=("a", "b"),
                           table_name="s -> t")
    chk = recon.record_diff_check(s, t, spec, "r", "2025-01-01 00:00:00").first()
    assert chk.mismatch_count == sum(brute_diff(src, tgt).values())


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(src=rows, tgt=rows, n=st.integers(1, 6))
def test_details_of_versions_equal_the_top_n_of_the_whole_diff(spark, src, tgt, n):
    s, t = spark.createDataFrame(src, SCHEMA), spark.createDataFrame(tgt, SCHEMA)
    whole = recon.diff_details(recon.record_diff(s, t, "id", ["a", "b"]), "id", "r", n)
    v = recon.versions(s, t, ["id", "a", "b"])
    fast = recon.details_of_versions(v, "id", ["a", "b"], "r", n)
    assert Counter(map(tuple, fast.collect())) == Counter(map(tuple, whole.collect()))


# ---------------------------------------------------------------- keep-first dedup

from lakecheck.operators import quality  # noqa: E402

dedup_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), val, txt), max_size=15)


def _nulls_last(x):
    return (x is None, x if x is not None else 0) if not isinstance(x, str) else (False, x)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=dedup_rows)
def test_dedup_keeps_the_first_row_per_key(spark, rows):
    # default order: every other column ascending, NULLs last; NULL keys group together
    df = spark.createDataFrame(rows, "k int, a int, b string")
    got = sorted(map(tuple, quality.dedup(df, ["k"]).collect()), key=repr)
    by_key = defaultdict(list)
    for r in rows:
        by_key[r[0]].append(r)
    want = sorted((min(rs, key=lambda r: (_nulls_last(r[1]), (r[2] is None, r[2] or ""))) for rs in by_key.values()),
                  key=repr)
    assert got == want


prof_rows = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(-2, 3)),
                               st.one_of(st.none(), st.integers(0, 4))), max_size=15)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=prof_rows, parents=st.lists(st.integers(0, 4), max_size=4))
def test_issue_profile_counts(spark, rows, parents):
    df = spark.createDataFrame(rows, "id int, amount int, fk int")
    par = spark.createDataFrame([(p,) for p in parents], "fk int")
    got = {r.issue: r.n for r in quality.profile(df, "id", "amount", "fk", par).collect()}
    assert got == {
        "duplicate_rows": len(rows) - len({r[0] for r in rows}),
        "null_amount": sum(r[1] is None for r in rows),
        "non_positive_amount": sum(r[1] is not None and r[1] <= 0 for r in rows),
        "orphan_fk": sum(r[2] is not None and r[2] not in set(parents) for r in rows),
    }


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=st.lists(st.integers(0, 4000), max_size=20))
def test_date_dim_against_python_dates(spark, days):
    base = dt.date(2020, 1, 1)
    dates = [base + dt.timedelta(days=d) for d in days]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    got = sorted(tuple(r) for r in dims.date_dim(df, "d").collect())
    want = sorted({(int(d.strftime("%Y%m%d")), d, d.year, d.month, (d.month - 1) // 3 + 1, d.strftime("%A"))
                   for d in dates})
    assert got == want


check_rows = st.lists(st.tuples(st.sampled_from(["r1", "r2"]), st.sampled_from(["t1", "t2"]),
                                st.sampled_from(["PASS", "FAIL"]), st.integers(0, 9)), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=check_rows)
def test_summary_against_brute_force(spark, rows):
    from lakecheck.operators import results
    df = spark.createDataFrame(rows, "run_id string, table_name string, status string, mismatch_count bigint") \
              .withColumn("run_ts", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    got = {(r.run_id, r.table_name): (r.total_checks, r.passed, r.failed, r.total_mismatches, r.overall_status)
           for r in results.summarize(df).collect()}
    want = {}
    for run, table, status, n in rows:
        t, p, f, m, _ = want.get((run, table), (0, 0, 0, 0, None))
        p, f = p + (status == "PASS"), f + (status == "FAIL")
        want[(run, table)] = (t + 1, p, f, m + n, "PASS" if f == 0 else "FAIL")
    assert got == want
