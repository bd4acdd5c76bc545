"""Deterministic row identifiers.

A row id is the SHA-256 of the row's defining values, so a recomputed
partition (after an executor loss) yields the same ids - a random UUID
would not.  The hashed text is injective: every value is its text behind its
length (``5:abcde``), a null is ``-``, and doubles enter with all their digits, so
different rows have different texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_MARK = "-"


def _text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.FloatType):
        c = c.cast("double")
    c = c.cast("string")
    return F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit(NULL_MARK))


def row_id(cols: Sequence[tuple[str, T.DataType]]) -> Column:
    """Hex SHA-256 over the length-prefixed values of ``(name, type)`` columns."""
    return F.sha2(F.concat(*[_text(F.col(n), t) for n, t in cols]), 256)
