"""Per-group top-k.

Both helpers run on an already aggregated frame and use a ranking window
with a ``<= k`` filter, which Spark plans as ``WindowGroupLimit``: every
map task keeps only its local top rows per group before the shuffle, so
even a group holding a third of all rows ships at most k (plus ties) rows
per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k_with_ties(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str | Column], k: int = 1) -> DataFrame:
    """Rows whose ``rank()`` within the group is at most ``k`` (all ties kept)."""
    w = Window.partitionBy(*group_by).orderBy(*_cols(order_by))
    return df.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def top_k(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str | Column], k: int = 1) -> DataFrame:
    """Exactly ``min(k, group size)`` rows per group (``row_number``); make
    ``order_by`` total (add a tie-break column) for a deterministic result."""
    w = Window.partitionBy(*group_by).orderBy(*_cols(order_by))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")
