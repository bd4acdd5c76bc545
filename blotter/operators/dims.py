"""Dimension tables and lookups (neighbourhood -> district, neighbourhood ->
point).

The fact table is joined to a dimension with a broadcast hash join only
when the dimension's size is proven: either it is a fixed literal table,
or a bounded row count (``limit(n + 1).count()``, which reads at most
``n + 1`` rows) shows it fits.  Beyond the bound the join is left to the
planner (sort-merge, or a runtime broadcast chosen by AQE from actual
shuffle sizes), so a dimension that unexpectedly grows never lands whole
in every executor's memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows up to which a dimension is broadcast without a second thought.
DEFAULT_BROADCAST_ROWS = 100_000

# The city's four police districts and the neighbourhoods in
# each (lower case, as stored in the clean table).  District 1: west end,
# central business district, stanley park.  District 2: strathcona,
# grandview-woodland, hastings-sunrise.  District 3: sunset,
# renfrew-collingwood, mount pleasant, killarney, victoria-fraserview,
# kensington-cedar cottage.  District 4: kitsilano, fairview,
# dunbar-southlands, arbutus ridge, shaughnessy, south cambie, riley park,
# musqueam, kerrisdale, oakridge, marpole, west point grey.
CITY_DISTRICTS: dict[int, list[str]] = {
    1: ["west end", "central business district", "stanley park"],
    2: ["strathcona", "grandview-woodland", "hastings-sunrise"],
    3: ["sunset", "renfrew-collingwood", "mount pleasant", "killarney", "victoria-fraserview",
        "kensington-cedar cottage"],
    4: ["kitsilano", "fairview", "dunbar-southlands", "arbutus ridge", "shaughnessy", "south cambie",
        "riley park", "musqueam", "kerrisdale", "oakridge", "marpole", "west point grey"],
}

DISTRICT_SCHEMA = T.StructType([
    T.StructField("neighbourhood", T.StringType(), False),
    T.StructField("district", T.IntegerType(), False),
])

POINT_SCHEMA = T.StructType([
    T.StructField("neighbourhood", T.StringType(), False),
    T.StructField("lat", T.DoubleType(), True),
    T.StructField("lon", T.DoubleType(), True),
])


def city_district_dim(spark: SparkSession, mapping: dict[int, list[str]] | None = None) -> DataFrame:
    """``(neighbourhood string, district int)`` built from a literal mapping
    (the city's fixed one by default)."""
    mapping = CITY_DISTRICTS if mapping is None else mapping
    rows = [(name, int(d)) for d, names in mapping.items() for name in names]
    return spark.createDataFrame(rows, DISTRICT_SCHEMA)


def point_dim(spark: SparkSession, rows: list[tuple[str, float, float]]) -> DataFrame:
    """``(neighbourhood, lat, lon)`` from caller-supplied, keyed rows.

    Points are always keyed by name: assigning them by the order in which
    distinct names happen to come back would change with every shuffle."""
    return spark.createDataFrame([(n, float(a), float(b)) for n, a, b in rows], POINT_SCHEMA)


def derived_point_dim(incidents: DataFrame, lat: str = "x", lon: str = "y") -> DataFrame:
    """Neighbourhood centroid from located incidents, for data sets without
    a point table.  One partial+final aggregate; rows without a position
    (0 or null) do not count."""
    located = incidents.filter((F.col(lat) != 0) & (F.col(lon) != 0))
    return located.groupBy("neighbourhood").agg(
        F.avg(lat).alias("lat"), F.avg(lon).alias("lon"))


def broadcast_checked(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only if the dimension provably has at most ``max_rows``
    rows.  The check reads at most ``max_rows + 1`` rows.  Otherwise the
    frame is returned unhinted and the planner/AQE choose the join."""
    if dim.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(dim)
    return dim


def with_district(incidents: DataFrame, districts: DataFrame, how: str = "left",
                  bounded: bool = False) -> DataFrame:
    """Neighbourhood -> district lookup (``district`` int; null when the
    neighbourhood is not in the dimension for ``how='left'``; the row is
    dropped for ``how='inner'``).

    ``bounded=True`` states that ``districts`` is a literal table whose size
    is known; otherwise its size is checked before broadcasting."""
    dim = F.broadcast(districts) if bounded else broadcast_checked(districts)
    return incidents.join(dim.select("neighbourhood", "district"), "neighbourhood", how)


def with_points(incidents: DataFrame, points: DataFrame, bounded: bool = False) -> DataFrame:
    """Neighbourhood -> (x_neighbourhood, y_neighbourhood) = (lat, lon); null
    for an unknown neighbourhood (never a task failure)."""
    dim = F.broadcast(points) if bounded else broadcast_checked(points)
    dim = dim.select(
        "neighbourhood",
        F.col("lat").alias("x_neighbourhood"),
        F.col("lon").alias("y_neighbourhood"),
    )
    return incidents.join(dim, "neighbourhood", "left")


def has_point(x: str | Column, y: str | Column, strict: bool = False) -> Column:
    """"Has coordinates" predicate.  Loose (default): keep unless both are
    0.  Strict: keep only if neither is 0.  SQL three-valued logic applies:
    a null coordinate never passes the strict form, and passes the loose
    form only when the other coordinate is non-zero."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    if strict:
        return (x != 0) & (y != 0)
    return (x != 0) | (y != 0)
