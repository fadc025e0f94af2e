"""Run one pipeline run from the command line (``spark-submit``, or ``python -m lakecheck``).

    spark-submit --py-files lakecheck.zip lakecheck/__main__.py \\
        --raw /shared/raw --out /shared/lake --run-id 20250601_000000 \\
        --run-ts "2025-06-01 00:00:00" --update --catalog

The session is the one the cluster provides (``getOrCreate``); its ``spark.checkpoint.dir``
must name a shared folder.  A patient dimension already under ``--out`` gets an
SCD2 update; ``--reset-dim`` starts it anew; ``--update`` demands that it exists; ``--catalog`` registers the layers as catalog tables in
the databases ``<prefix>_bronze`` ... ``<prefix>_results``.  Prints the run's summary rows.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from lakecheck.plans import pipeline
from lakecheck.session import ensure_checkpoint_dir


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="lakecheck", description=__doc__.split("\n\n")[0])
    ap.add_argument("--raw", required=True, help="folder holding the raw CSV files")
    ap.add_argument("--out", required=True, help="folder of the layered datasets")
    ap.add_argument("--run-ts", help="run timestamp 'yyyy-MM-dd HH:mm:ss' (default: now)")
    ap.add_argument("--run-id", help="run id (default: the run timestamp as yyyyMMdd_HHmmss)")
    ap.add_argument("--as-of", help="SCD2 date of this load (default: the run date)")
    ap.add_argument("--update", action="store_true", help="demand an existing dimension and update it")
    ap.add_argument("--reset-dim", action="store_true", help="replace an existing dimension by a first load")
    ap.add_argument("--catalog", nargs="?", const="lakecheck", metavar="PREFIX",
                    help="register the layers as catalog tables in PREFIX_bronze ... PREFIX_results")
    a = ap.parse_args(argv)

    ts = dt.datetime.strptime(a.run_ts, "%Y-%m-%d %H:%M:%S") if a.run_ts else dt.datetime.now().replace(microsecond=0)
    run_ts = ts.strftime("%Y-%m-%d %H:%M:%S")
    run_id = a.run_id or ts.strftime("%Y%m%d_%H%M%S")
    spark = SparkSession.builder.appName(f"lakecheck {run_id}").getOrCreate()
    ensure_checkpoint_dir(spark)
    previous = spark.read.parquet(f"{a.out.rstrip('/')}/gold/dim_patient") if a.update else None
    catalog = ({layer: f"{a.catalog}_{layer}" for layer in ("bronze", "silver", "gold", "results")}
               if a.catalog else None)
    out = pipeline.run(spark, a.raw, a.out, run_id, run_ts, as_of=a.as_of, previous_dim=previous,
                       catalog=catalog, reset_dim=a.reset_dim)
    out["run_summary"].show(truncate=False)


if __name__ == "__main__":
    main()
