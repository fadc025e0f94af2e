"""Writers: full refresh, append, run-partitioned overwrite, staged replace, CSV export."""

from lakecheck.sinks.writers import (append, ensure_database, export_csv, materialize, observed,
                                     overwrite, read_runs, register_table, save_table, staged_replace,
                                     write_runs)

__all__ = ["append", "ensure_database", "export_csv", "materialize", "observed", "overwrite",
           "read_runs", "register_table", "save_table", "staged_replace", "write_runs"]
