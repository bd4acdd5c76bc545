"""Count rollups and table profiles.

The five dashboard rollups are counts over small dimensions (year, type,
neighbourhood, month, hour).  :func:`rollups` scans the incident table once
into one partially aggregated base ``(year, month, hour, type,
neighbourhood, n)`` - bounded by the product of the dimension
cardinalities, not by the row count - and derives all five result tables
from it.  :func:`rollup_grouping_sets` gives the same counts in long form
with one ``GROUPING SETS`` aggregate over that base (still one scan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Result table -> grouping columns (FIXTURES.md §5).
ROLLUP_GRAINS: dict[str, tuple[str, ...]] = {
    "type": ("year", "type"),
    "neighbourhood": ("year", "neighbourhood"),
    "month": ("year", "month"),
    "hour": ("year", "hour"),
    "type_neighbourhood": ("year", "type", "neighbourhood"),
}


def count_by(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(cols..., count bigint)``; one partial + final hash aggregate."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def rollup(incidents: DataFrame, grain: str) -> DataFrame:
    """One rollup table straight from the incident table."""
    return count_by(incidents.select(*ROLLUP_GRAINS[grain]), ROLLUP_GRAINS[grain])


def rollup_base(incidents: DataFrame) -> DataFrame:
    """Finest grain every rollup can be derived from."""
    cols = ["year", "month", "hour", "type", "neighbourhood"]
    return count_by(incidents.select(*cols), cols)


def rollups(incidents: DataFrame, base: DataFrame | None = None) -> dict[str, DataFrame]:
    """All five rollup tables from one base aggregate.  Persist ``base`` (or
    pass a persisted one) when more than one result is materialised."""
    base = rollup_base(incidents) if base is None else base
    return {grain: base.groupBy(*cols).agg(F.sum("count").alias("count"))
            for grain, cols in ROLLUP_GRAINS.items()}


def rollup_grouping_sets(incidents: DataFrame, grains: Sequence[str] = tuple(ROLLUP_GRAINS)) -> DataFrame:
    """All rollups in one pass: ``(grain, year, type, neighbourhood, month,
    hour, count)``; columns outside a row's grain are null.

    The incident table is scanned once into the base aggregate; the grouping
    sets (an ``Expand`` of every row once per grain) then run on that small
    base, not on the raw rows."""
    dims = ["year", "type", "neighbourhood", "month", "hour"]
    base = rollup_base(incidents)
    sets = [[F.col(c) for c in ROLLUP_GRAINS[g]] for g in grains]
    agg = base.groupingSets(sets, *dims).agg(
        F.sum("count").alias("count"), F.grouping_id(*dims).alias("_gid"))
    # grouping_id bit i (from the left, most significant first) is 1 when
    # dims[i] is aggregated away.
    def gid(grain: str) -> int:
        return sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in ROLLUP_GRAINS[grain])
    label = F.lit(None).cast("string")
    for g in grains:
        label = F.when(F.col("_gid") == gid(g), F.lit(g)).otherwise(label)
    return agg.select(label.alias("grain"), *dims, "count")


def rollups_long(tables: dict[str, DataFrame]) -> DataFrame:
    """Stack rollup tables into one long table ``(grain, year, type,
    neighbourhood, month, hour, count)`` by column name (``unionByName``,
    missing columns null) - the N-way union form of the grouping sets."""
    dims = ["year", "type", "neighbourhood", "month", "hour"]
    parts = [t.withColumn("grain", F.lit(g)) for g, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select("grain", *dims, "count")


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """One row: ``n_distinct_<col>`` per column (exact; HyperLogLog++ with
    ``approx=True`` for very high cardinalities)."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[fn(F.col(c)).alias(f"n_distinct_{c}") for c in cols])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, count)`` per distinct value, most frequent first."""
    return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("value")))


def table_summary(df: DataFrame) -> DataFrame:
    """``(column_name, non_null bigint, data_type)`` per column: one pass of
    ``count(col)`` aggregates, turned long with ``unpivot``."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    long = counts.unpivot([], list(df.columns), "column_name", "non_null")
    types = df.sparkSession.createDataFrame(list(df.dtypes), "column_name string, data_type string")
    return long.join(F.broadcast(types), "column_name")


def any_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``any_zero_<col>`` = does any row have 0 in the column."""
    return df.agg(*[F.coalesce(F.bool_or(F.col(c) == 0), F.lit(False)).alias(f"any_zero_{c}") for c in cols])
