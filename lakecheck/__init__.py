"""lakecheck: layered-table building and source-vs-target reconciliation on Spark.

Every operator is a DataFrame -> DataFrame function; keys, columns, dates and run ids
are parameters.  Sub-packages:

* ``sources``   - CSV ingest with lineage columns, the given Parquet tables, test fixtures
* ``sinks``     - overwrite / append / run-partitioned / staged writes, CSV export
* ``functions`` - column-expression helpers (row hash, predicates, date keys)
* ``operators`` - quality, numbering, dimensions (SCD2), facts, reconciliation, results
* ``plans``     - the end-to-end pipeline, the registered queries and their SQL oracles
"""

__version__ = "0.1.0"
