"""Session helpers: a local session for tests/bench and the shared scratch location."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

# Settings every lakecheck job relies on.  AQE re-plans joins by runtime size and splits
# skewed partitions; the session time zone only matters for timestamp <-> text casts.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "lakecheck", extra: dict | None = None) -> SparkSession:
    """A session for tests and the bench.  On a cluster, use the session you are given."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None where the session has none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or the context's)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    sc = _context(spark)
    return sc.getCheckpointDir() if sc is not None else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint dir; only when none is configured (tests) set a local one.
    A session without a context (Spark Connect) must name it in ``spark.checkpoint.dir``."""
    d = checkpoint_dir(spark)
    sc = _context(spark)
    if sc is None:
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return d
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="lakecheck-ckpt-")
        sc.setCheckpointDir(d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lakecheck/{name}-{uuid.uuid4().hex[:12]}"


# fixed values: target bytes per input split and per shuffle partition when sizing a job
SPLIT_BYTES = 256 << 20
SHUFFLE_PARTITION_BYTES = 256 << 20


def input_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Total size of the files under ``paths``, asked of their Hadoop file system (a
    metadata call per path, no data read)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        fs = jp.getFileSystem(conf)
        if fs.exists(jp):
            total += fs.getContentSummary(jp).getLength()
    return total


def size_for_input(spark: SparkSession, paths: Sequence[str], expansion: float = 3.0,
                   apply: bool = True) -> dict[str, str]:
    """Settings that keep input splits and shuffle partitions near 256 MB for the given
    inputs: ``spark.sql.files.maxPartitionBytes`` and ``spark.sql.shuffle.partitions`` (the
    compressed input times ``expansion`` for decoded rows, over 256 MB; never below the
    cluster's default parallelism, so every core has a task).  AQE then coalesces small
    partitions and splits skewed ones at run time.  With ``apply`` the three settings are
    set on the session; the computed values are returned either way."""
    n = input_bytes(spark, paths)
    sc = _context(spark)
    parallelism = sc.defaultParallelism if sc is not None else int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parallelism, math.ceil(n * expansion / SHUFFLE_PARTITION_BYTES))
    conf = {"spark.sql.files.maxPartitionBytes": str(SPLIT_BYTES),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PARTITION_BYTES),
            "spark.sql.shuffle.partitions": str(parts)}
    if apply:
        for k, v in conf.items():
            spark.conf.set(k, v)
    return conf
