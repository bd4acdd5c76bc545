"""Raw incident records -> clean incident table.

One plan: drop incomplete rows, drop exact duplicates, lower-case
the text columns, look up the neighbourhood point (broadcast of a bounded
dimension), keep rows with a position, project the position to
latitude/longitude, clean the block name, build the timestamp and a
deterministic id - all with built-in expressions.  The only shuffle is the
duplicate removal, which Spark runs as a partial + final aggregate, so a
record repeated a billion times is collapsed map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import utm_to_latlon
from ..functions.ids import row_id
from ..functions.text import clean_block
from ..functions.timefn import incident_timestamp
from ..sources.files import CLEAN_SCHEMA, RAW_SCHEMA
from .dims import derived_point_dim, has_point, with_points

CLEAN_COLUMNS = CLEAN_SCHEMA.fieldNames()
RAW_COLUMNS = RAW_SCHEMA.fieldNames()


def clean_incidents(raw: DataFrame, points: DataFrame | None, coordinate_filter: str = "loose", zone: int = 10,
                    northern: bool = True, bounded_points: bool = False) -> DataFrame:
    """Raw rows ``(type, year, month, day, hour, minute, hundred_block,
    neighbourhood, x, y)`` with ``x``/``y`` = UTM easting/northing ->
    the 14-column clean table where ``x`` = latitude, ``y`` = longitude.

    * rows with any null/NaN are dropped, then exact duplicates; lower-casing
      happens after that, so rows differing only in case both stay;
    * ``coordinate_filter``: ``loose`` keeps a row unless both coordinates
      are 0, ``strict`` needs both non-zero; a kept position outside the UTM
      range projects to null;
    * ``points`` None: the point of a neighbourhood is the centroid of its
      located incidents (the cleaned rows are read a second time for that);
      an unknown neighbourhood gets null ``x_neighbourhood``/``y_neighbourhood``;
    * an impossible date/time gives a null ``timestamp``;
    * ``id`` = SHA-256 of the raw record (unique after duplicate removal,
      stable under recomputation)."""
    return shaped(identified(raw.select(*RAW_COLUMNS).dropna(how="any").distinct()), points, coordinate_filter, zone, northern, bounded_points)


def identified(raw: DataFrame) -> DataFrame:
    """Raw columns and the ``id`` of each row (equal rows have equal ids)."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    return raw.select(*RAW_COLUMNS).withColumn("id", row_id([(c, types[c]) for c in RAW_COLUMNS]))


def shaped(df: DataFrame, points: DataFrame | None, coordinate_filter: str = "loose", zone: int = 10, northern: bool = True,
           bounded_points: bool = False) -> DataFrame:
    """The row-wise steps: complete, distinct, :func:`identified` raw rows -> the clean table."""
    df = df.withColumns({c: F.lower(F.col(c)) for c in ("type", "hundred_block", "neighbourhood")})
    df = df.filter(has_point("x", "y", strict=coordinate_filter == "strict"))
    lat, lon = utm_to_latlon("x", "y", zone=zone, northern=northern)
    df = df.withColumns({
        "x": lat,
        "y": lon,
        "hundred_block": clean_block(F.col("hundred_block")),
        "timestamp": incident_timestamp("year", "month", "day", "hour", "minute"),
    })
    if points is None:
        points = derived_point_dim(df)
    return with_points(df, points, bounded=bounded_points).select(*CLEAN_COLUMNS)
