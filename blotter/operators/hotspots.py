"""District and block hot spots (the per-district jobs).

All jobs share one shape: prune columns and push the year filter into the
scan, map neighbourhood -> district with a broadcast of the (bounded)
district dimension, aggregate once with map-side partial aggregation, and
do any ranking on the aggregated rows.  No job iterates districts or years
on the driver; a district or block holding a third of all incidents is
collapsed by the partial aggregate before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import title_hyphenated
from ..session import cut_lineage
from .dims import has_point, with_district
from .topk import top_k, top_k_with_ties

# The years, the pair left out of the top blocks, and the
# blocks of the map layer.
REFERENCE_YEARS = (2020, 2021, 2022)
REFERENCE_LEFT_OUT = (("strathcona", "e hastings st"),)
REFERENCE_MAP_BLOCKS = ("e hastings st", "nk_loc st", "commercial dr")

# Display names of the result tables as the dashboard shows them.
HOT_BLOCK_DISPLAY = {"year": "Year", "hundred_block": "Hundred Block", "total_crime": "Total Crime",
                     "district": "District"}
TOP_BLOCK_DISPLAY = {"district": "District", "neighbourhood": "Neighbourhood",
                     "hundred_block": "Hundred Block", "crime_count": "Crime Count (2020-2022)"}


def display(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename result columns to display names (presentation only)."""
    return df.withColumnsRenamed(names)


def _located(incidents: DataFrame, coordinate_filter: str | None) -> DataFrame:
    """Rows whose neighbourhood point passes the filter.  A neighbourhood
    without a known point (null) passes: unknown is not zero."""
    if coordinate_filter is None:
        return incidents
    known = has_point("x_neighbourhood", "y_neighbourhood", strict=coordinate_filter == "strict")
    return incidents.filter(F.coalesce(known, F.lit(True)))


def district_year_hot_blocks(incidents: DataFrame, districts: DataFrame, after_year: int = 2019,
                             bounded_dim: bool = False) -> DataFrame:
    """Per district and year (``year > after_year``), the block(s) with the
    most incidents; ties are all kept.

    -> ``year int, hundred_block string, total_crime bigint, district int``.
    Incidents whose neighbourhood has no district are left out."""
    counts = (
        incidents.filter(F.col("year") > after_year)
        .select("neighbourhood", "year", "hundred_block")
        .transform(lambda d: with_district(d, districts, how="inner", bounded=bounded_dim))
        .groupBy("district", "year", "hundred_block")
        .agg(F.count(F.lit(1)).alias("total_crime"))
    )
    best = top_k_with_ties(counts, ["district", "year"], [F.desc("total_crime")], k=1)
    return best.select("year", "hundred_block", "total_crime", "district")


def district_year_counts(incidents: DataFrame, districts: DataFrame,
                         years: Sequence[int] = REFERENCE_YEARS, bounded_dim: bool = False) -> DataFrame:
    """Incidents per district, one column per year (named by the year).

    A district with no incident in one of the years is absent, as is the
    unmapped (null) district.  -> ``district int, "<year>" bigint ...``"""
    years = [int(y) for y in years]
    per = (
        incidents.filter(F.col("year").isin(years))
        .select("neighbourhood", "year")
        .transform(lambda d: with_district(d, districts, how="inner", bounded=bounded_dim))
        .groupBy("district")
        .pivot("year", years)
        .agg(F.count(F.lit(1)))
    )
    return per.dropna(how="any")


def district_year_counts_long(wide: DataFrame) -> DataFrame:
    """Wide district-by-year table -> long ``(district, year int, count bigint)``."""
    year_cols = [c for c in wide.columns if c != "district"]
    long = wide.unpivot("district", year_cols, "year", "count")
    return long.select("district", F.col("year").cast("int").alias("year"), "count")


def least_district_top_blocks(incidents: DataFrame, districts: DataFrame,
                              years: Sequence[int] = REFERENCE_YEARS,
                              exclude: Sequence[tuple[str, str]] = REFERENCE_LEFT_OUT,
                              coordinate_filter: str | None = "loose",
                              bounded_dim: bool = False) -> DataFrame:
    """The district with the fewest incidents over ``years`` (only districts
    present in every year compete; ties -> lowest district number), then
    for each of its neighbourhoods the block with the most incidents
    (ties -> alphabetically first block), leaving out the
    ``(neighbourhood, block)`` pairs in ``exclude``.

    -> ``district int, neighbourhood string (display case), hundred_block
    string, crime_count bigint``"""
    years = [int(y) for y in years]
    spark = incidents.sparkSession
    per = (
        _located(incidents, coordinate_filter)
        .filter(F.col("year").isin(years))
        .select("neighbourhood", "hundred_block", "year")
        .transform(lambda d: with_district(d, districts, how="inner", bounded=bounded_dim))
        .groupBy("district", "neighbourhood", "hundred_block", "year")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The per-block table is small (one row per district, neighbourhood,
    # block and year) and feeds two branches: materialise it once in the
    # checkpoint folder so the incident table is scanned once.
    per = cut_lineage(per)
    totals = (
        per.groupBy("district")
        .agg(F.sum("n").alias("total"), F.count_distinct("year").alias("n_years"))
        .filter(F.col("n_years") == len(years))
    )
    # One row by construction (ordered limit 1), so broadcasting it is safe.
    least = totals.orderBy("total", "district").limit(1).select("district")
    blocks = per.join(F.broadcast(least), "district")
    if exclude:
        schema = T.StructType([T.StructField("neighbourhood", T.StringType()),
                               T.StructField("hundred_block", T.StringType())])
        ex = spark.createDataFrame([tuple(p) for p in exclude], schema)
        blocks = blocks.join(F.broadcast(ex), ["neighbourhood", "hundred_block"], "left_anti")
    per_block = blocks.groupBy("district", "neighbourhood", "hundred_block").agg(F.sum("n").alias("crime_count"))
    best = top_k(per_block, ["neighbourhood"], [F.desc("crime_count"), F.asc("hundred_block")], k=1)
    return best.select(
        "district",
        title_hyphenated(F.col("neighbourhood")).alias("neighbourhood"),
        "hundred_block",
        "crime_count",
    )


def district_points(incidents: DataFrame, districts: DataFrame, district: int,
                    years: Sequence[int] = REFERENCE_YEARS, blocks: Sequence[str] | None = None,
                    coordinate_filter: str | None = "loose", bounded_dim: bool = False) -> DataFrame:
    """Incident positions ``(x, y)`` of one district over ``years``,
    optionally only for the given blocks (the hot-block map layer).

    Only the district's own rows of the dimension are broadcast; year and
    block predicates are pushed into the scan as ``In`` filters."""
    df = _located(incidents, coordinate_filter).filter(F.col("year").isin([int(y) for y in years]))
    if blocks is not None:
        df = df.filter(F.col("hundred_block").isin(list(blocks)))
    dim = districts.filter(F.col("district") == int(district))
    df = with_district(df.select("neighbourhood", "x", "y"), dim, how="inner", bounded=bounded_dim)
    return df.select("x", "y")


def hot_block_points(incidents: DataFrame, districts: DataFrame, district: int, blocks: Sequence[str],
                     years: Sequence[int] = REFERENCE_YEARS, coordinate_filter: str | None = "loose",
                     bounded_dim: bool = False) -> DataFrame:
    """Positions of incidents in the listed blocks of one district."""
    return district_points(incidents, districts, district, years, blocks, coordinate_filter, bounded_dim)


def reference_run(spark: SparkSession, incidents: DataFrame) -> dict[str, DataFrame]:
    """The reference's district jobs with its own parameters on a clean
    incident table (city district map)."""
    from .dims import city_district_dim

    dim = city_district_dim(spark)
    return {
        "district_year_counts": district_year_counts(incidents, dim, bounded_dim=True),
        "least_district_top_blocks": least_district_top_blocks(incidents, dim, bounded_dim=True),
        "district_points": district_points(incidents, dim, 2, bounded_dim=True),
        "hot_block_points": hot_block_points(incidents, dim, 2, REFERENCE_MAP_BLOCKS, bounded_dim=True),
        "district_year_hot_blocks": district_year_hot_blocks(incidents, dim, bounded_dim=True),
    }
