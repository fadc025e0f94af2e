"""Column-expression helpers.  All are built-in Spark expressions (codegen, no UDF)."""

from lakecheck.functions.hashing import hash60, row_hash, text_form
from lakecheck.functions.predicates import any_changed, any_differs, positive_not_null
from lakecheck.functions.dates import date_key, run_id_of, weekday_name

__all__ = [
    "hash60", "row_hash", "text_form",
    "any_changed", "any_differs", "positive_not_null",
    "date_key", "run_id_of", "weekday_name",
]
