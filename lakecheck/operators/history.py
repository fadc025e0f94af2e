"""Change-only history: what every run's snapshot held, stored as intervals of runs instead of a copy per run.

An interval is a distinct row with its number of copies and the runs it was there for: ``from_run`` is the first, ``to_run`` the
first without it (NULL: still there).  A row that changes closes its interval and the new values open another; a row
that comes back opens a new one.  So the history grows with changes, not with runs, and any run can be rebuilt exactly,
repeated rows and NULLs included.

Runs are ordered by their id's text, as elsewhere.  ``append_run`` compares the open intervals with a snapshot by one grouped
union (no join, so NULLs need no care, and copies combine before the shuffle).  Closed intervals are written once, under
the run that closed them; the open ones are rewritten, as the snapshot itself would be.  The list of runs is the
commit: it is switched last (``sinks.versioned``) and names the folder of open intervals, so a job that died before it
changed nothing that readers see.  The last run can be repeated; it starts again from the run before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakecheck.sinks import runs, versioned
from lakecheck.sinks.writers import path_exists, read_runs

FROM, TO, COPIES = "from_run", "to_run", "n_rows"


def compact(history: DataFrame, run_col: str) -> DataFrame:
    """The intervals of a full history (one copy of every row per run): columns without the run, copies, from, to.  A run
    without rows is not seen here, as nothing in the history names it."""
    cols = [c for c in history.columns if c != run_col]
    order = history.select(F.col(run_col).alias(FROM)).distinct()
    numbered = order.select(FROM, F.row_number().over(Window.orderBy(FROM)).alias("__lc_i"),      # one row a run
                            F.lead(FROM).over(Window.orderBy(FROM)).alias("__lc_next"))
    v = history.groupBy(*cols, F.col(run_col).alias(FROM)).agg(F.count(F.lit(1)).alias(COPIES)).join(numbered, FROM)
    same = Window.partitionBy(*cols, COPIES).orderBy("__lc_i")                                   # at most one row a run
    island = v.withColumn("__lc_g", F.col("__lc_i") - F.row_number().over(same))
    return island.groupBy(*cols, COPIES, "__lc_g").agg(F.min(FROM).alias(FROM), F.max_by("__lc_next", "__lc_i").alias(TO)).drop("__lc_g")


def next_intervals(open_: DataFrame, snapshot: DataFrame, run_id: str) -> DataFrame:
    """Open intervals (columns, copies, from) and a new snapshot -> all of them with ``to_run``: kept, opened, or closed
    by ``run_id``."""
    cols = snapshot.columns
    now = snapshot.groupBy(*cols).agg(F.count(F.lit(1)).alias(COPIES))
    both = (open_.select(*cols, COPIES, FROM, F.lit(False).alias("__lc_now"))
            .unionByName(now.select(*cols, COPIES, F.lit(None).cast("string").alias(FROM), F.lit(True).alias("__lc_now"))))
    g = both.groupBy(*cols, COPIES).agg(F.max(FROM).alias(FROM), F.max("__lc_now").alias("__lc_now"))
    return g.select(*cols, COPIES, F.coalesce(FROM, F.lit(run_id)).alias(FROM), F.when(~F.col("__lc_now"), F.lit(run_id)).alias(TO))


def _commits(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(run id, folder of open intervals) of the runs, in order."""
    if versioned.current_version(spark, f"{path}/runs") is None:
        return []
    return sorted((r["run"], r["folder"]) for r in versioned.read(spark, f"{path}/runs").collect())     # one row a run


def append_run(spark: SparkSession, path: str, snapshot: DataFrame, run_id: str) -> None:
    """Add a run, or repeat the last one.  The snapshot has the columns of the first run's."""
    path = path.rstrip("/")
    done = [c for c in _commits(spark, path) if c[0] != run_id]
    if done and done[-1][0] > run_id:
        raise ValueError(f"runs are appended in order; {run_id} comes before {done[-1][0]}")
    if done:
        open_ = spark.read.parquet(f"{path}/open/{done[-1][1]}")
    else:
        open_ = snapshot.withColumns({COPIES: F.lit(0).cast("bigint"), FROM: F.lit("")}).limit(0)
    both = next_intervals(open_, snapshot, run_id)
    folder = f"o-{uuid.uuid4().hex[:12]}"
    # one pass: rows still there and rows closed go to two folders of one staged write
    staged = f"{path}/open/{folder}-all"
    both.withColumn("__lc_open", F.col(TO).isNull()).write.partitionBy("__lc_open").parquet(staged)
    rows = spark.read.schema(both.withColumn("__lc_open", F.lit(True)).schema).parquet(staged)
    rows.where("__lc_open").drop("__lc_open", TO).write.parquet(f"{path}/open/{folder}")
    runs.write_run(rows.where("not __lc_open").drop("__lc_open"), f"{path}/closed", run_id, TO)
    versioned.replace(spark.createDataFrame([*done, (run_id, folder)], "run string, folder string"), f"{path}/runs")
    _clear(spark, path, {f for _, f in [*done, (run_id, folder)][-2:]})


def _clear(spark: SparkSession, path: str, kept: set[str]) -> None:
    """Remove folders of open intervals that neither the last run nor the one before it names."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/open")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for s in fs.listStatus(root):
        if s.getPath().getName() not in kept:
            fs.delete(s.getPath(), True)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All intervals of the committed runs."""
    path = path.rstrip("/")
    done = _commits(spark, path)
    if not done:
        raise FileNotFoundError(f"{path} has no run")
    open_ = spark.read.parquet(f"{path}/open/{done[-1][1]}").withColumn(TO, F.lit(None).cast("string"))
    if not path_exists(spark, f"{path}/closed"):
        return open_
    closed = read_runs(spark, f"{path}/closed", run_col=TO).where(F.col(TO).isin([r for r, _ in done]))
    return closed.select(*open_.columns).unionByName(open_)


def run_ids(spark: SparkSession, path: str) -> list[str]:
    return [r for r, _ in _commits(spark, path.rstrip("/"))]


def as_of(intervals: DataFrame, run_id: str) -> DataFrame:
    """The distinct rows of one run with their copies."""
    there = (F.col(FROM) <= F.lit(run_id)) & (F.col(TO).isNull() | (F.col(TO) > F.lit(run_id)))
    return intervals.where(there).drop(FROM, TO)


def expand(intervals: DataFrame, run_ids: Sequence[str], run_col: str) -> DataFrame:
    """The distinct rows of every run with their copies: the full history again."""
    every = F.array(*[F.lit(r) for r in run_ids]) if run_ids else F.array().cast("array<string>")
    lasting = F.filter(every, lambda r: (r >= F.col(FROM)) & (F.col(TO).isNull() | (r < F.col(TO))))
    return intervals.withColumn(run_col, F.explode(lasting)).drop(FROM, TO)


def copies(rows: DataFrame) -> DataFrame:
    """Each row as often as its ``n_rows`` says."""
    from lakecheck.operators.recon import expand_diff
    return expand_diff(rows)


__all__: Sequence[str] = ["append_run", "as_of", "compact", "copies", "expand", "next_intervals", "read", "run_ids"]
