"""Row hashes and the order-independent table fingerprint term.

The text form of a row is ``concat_ws(sep, cast(c as string) ...)``.  ``concat_ws`` skips
NULLs, so by default ``('a', NULL, 'b')`` and ``('a', 'b')`` hash alike, as in the reference;
give ``null_token`` to make NULL positions count.  Floating point columns can be rendered
through ``decimal(38, scale)`` so the text is engine independent (Spark prints ``1.0E7``
where other engines print ``10000000.0``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: separator between column texts, and hex digits of md5 kept per row
DEFAULT_SEP = "||"
HASH_HEX_DIGITS = 15  # 15 hex digits = 60 bits, summed as decimal(38,0)


def text_form(c: Column, dtype: T.DataType, decimal_scale: int | None = None,
              null_token: str | None = None) -> Column:
    """Canonical text of one value, used inside row hashes."""
    if decimal_scale is not None and isinstance(dtype, (T.DoubleType, T.FloatType)):
        txt = c.cast(T.DecimalType(38, decimal_scale)).cast("string")
    else:
        txt = c.cast("string")
    if null_token is not None:
        txt = F.coalesce(txt, F.lit(null_token))
    return txt


def row_hash(df: DataFrame, cols: Sequence[str], sep: str = DEFAULT_SEP,
             decimal_scale: int | None = None, null_token: str | None = None) -> Column:
    """md5 hex digest of the row text over ``cols`` of ``df``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [text_form(F.col(c), types[c], decimal_scale, null_token) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def hash60(hex_digest: Column) -> Column:
    """First 60 bits of a hex digest as decimal(38,0); sums of these are order independent."""
    return F.conv(F.substring(hex_digest, 1, HASH_HEX_DIGITS), 16, 10).cast(T.DecimalType(38, 0))
