"""Generated predicates over column lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_changed(pairs: Sequence[tuple[Column, Column]], null_safe: bool = False) -> Column:
    """OR over ``a <> b`` (reference semantics: NULL on either side yields NULL, so a change
    to or from NULL is not seen) or, with ``null_safe``, over ``NOT (a <=> b)``."""
    if null_safe:
        terms = [~a.eqNullSafe(b) for a, b in pairs]
    else:
        terms = [a != b for a, b in pairs]
    return reduce(or_, terms)


def any_differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """OR over ``NOT (s <=> t)``; equal to the reference's ``(s <> t) OR (isnull(s) <> isnull(t))``
    per column under three-valued logic: both NULL is not a difference."""
    return reduce(or_, [~s.eqNullSafe(t) for s, t in pairs], F.lit(False))


def positive_not_null(*cols: str) -> Column:
    """``c IS NOT NULL AND c > 0`` for every column."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.col(c) > 0) for c in cols])
