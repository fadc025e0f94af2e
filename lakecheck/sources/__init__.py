"""Scans: CSV ingest with lineage columns, the given Parquet tables, derived test inputs."""

from lakecheck.sources.csv import ingest, read_csv
from lakecheck.sources.tables import load

__all__ = ["ingest", "read_csv", "load"]
