"""Data behind the dashboard charts (the web page itself is not rebuilt).

The dashboard reads the small rollup tables and slices them per year; here
every chart's data is a DataFrame over those tables: filter by year,
re-aggregate, order.  Nothing is pulled to the driver except by the
caller's final action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def totals(rollup_table: DataFrame, year: int, by: str, descending: bool = False) -> DataFrame:
    """``(by, total)`` for one year, ordered by total (ties by name)."""
    out = (rollup_table.filter(F.col("year") == year)
           .groupBy(by).agg(F.sum("count").cast("bigint").alias("total")))
    order = F.desc("total") if descending else F.asc("total")
    return out.orderBy(order, F.asc(by))


def type_totals(by_type: DataFrame, year: int) -> DataFrame:
    """Incidents per type for one year, smallest first."""
    return totals(by_type, year, "type", descending=False)


def neighbourhood_totals(by_neighbourhood: DataFrame, year: int) -> DataFrame:
    """Incidents per neighbourhood for one year, largest first."""
    return totals(by_neighbourhood, year, "neighbourhood", descending=True)


def stacked(by_type_neighbourhood: DataFrame, year: int) -> DataFrame:
    """Type x neighbourhood counts of one year (stacked bars)."""
    return (by_type_neighbourhood.filter(F.col("year") == year)
            .select("neighbourhood", "type", "count").orderBy("neighbourhood", "type"))


def line(rollup_table: DataFrame, year: int, x: str) -> DataFrame:
    """``(x, count)`` of one year ordered by ``x`` (month or hour line)."""
    return rollup_table.filter(F.col("year") == year).select(x, "count").orderBy(x)


def years(rollup_table: DataFrame) -> DataFrame:
    """Distinct years, ascending (the year picker)."""
    return rollup_table.select("year").distinct().orderBy("year")


def district_series(district_wide: DataFrame) -> DataFrame:
    """District-by-year wide table -> long rows for grouped bars."""
    from ..operators.hotspots import district_year_counts_long
    return district_year_counts_long(district_wide)
