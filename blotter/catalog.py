"""Registered queries over the supplied test tables, with DuckDB oracles.

Each entry maps a key to ``(spark_fn, oracle_sql)``; ``spark_fn(spark,
sf_dir)`` returns a DataFrame built only from library operators applied to
the stand-in tables of :mod:`blotter.sources.testdata`.  ``oracle_sql`` is
an independent DuckDB formulation over the raw views (``None`` for the
Spark ML pipelines, which have no SQL formulation: those are checked by
rows here and by unit tests).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import geo, text, timefn
from .operators import cleaning, dims, holidays, hotspots, metrics, rollups, sketches, topk
from .plans import classify, dashboard, forest, knn
from .session import cut_lineage
from .sources import testdata as td

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(key: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


# Parameters fitted to the stand-in data (orders span 1995-2001), in the
# roles the original jobs give them: hot blocks after a year (there: 2019),
# three consecutive years (2020-2022), one district (2) and three of its
# blocks, one block left out of one neighbourhood.
HOT_AFTER_YEAR = 1997
TEST_YEARS = (1998, 1999, 2000)
TEST_DISTRICT = 2
TEST_BLOCKS = ("household 3", "machinery 7", "building 11")
TEST_EXCLUDE = (("nation_14", "household 7"),)

_INC = td.with_ctes(td.INCIDENTS_SQL, td.DISTRICTS_SQL)


# --------------------------------------------------------------- hot spots
@register("district_year_hot_blocks", _INC + f"""
, c AS (
  SELECT d.district, i.year, i.hundred_block, count(*) AS total_crime
  FROM incidents i JOIN districts d ON i.neighbourhood = d.neighbourhood
  WHERE i.year > {HOT_AFTER_YEAR}
  GROUP BY d.district, i.year, i.hundred_block)
SELECT year, hundred_block, total_crime, district FROM c
WHERE total_crime = (SELECT max(total_crime) FROM c c2 WHERE c2.district = c.district AND c2.year = c.year)
""")
def q_district_year_hot_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots.district_year_hot_blocks(td.incidents(spark, sf_dir), td.district_dim(spark, sf_dir),
                                             after_year=HOT_AFTER_YEAR)


_LOOSE = "(i.x_neighbourhood <> 0 OR i.y_neighbourhood <> 0)"
_YEARS_IN = ", ".join(str(y) for y in TEST_YEARS)


@register("district_year_counts", _INC + f"""
SELECT d.district,
       count(*) FILTER (WHERE i.year = {TEST_YEARS[0]}) AS "{TEST_YEARS[0]}",
       count(*) FILTER (WHERE i.year = {TEST_YEARS[1]}) AS "{TEST_YEARS[1]}",
       count(*) FILTER (WHERE i.year = {TEST_YEARS[2]}) AS "{TEST_YEARS[2]}"
FROM incidents i JOIN districts d ON i.neighbourhood = d.neighbourhood
WHERE i.year IN ({_YEARS_IN})
GROUP BY d.district
HAVING count(*) FILTER (WHERE i.year = {TEST_YEARS[0]}) > 0
   AND count(*) FILTER (WHERE i.year = {TEST_YEARS[1]}) > 0
   AND count(*) FILTER (WHERE i.year = {TEST_YEARS[2]}) > 0
""")
def q_district_year_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots.district_year_counts(td.incidents(spark, sf_dir), td.district_dim(spark, sf_dir), TEST_YEARS)


@register("district_year_counts_long", _INC + f"""
SELECT d.district, i.year, count(*) AS count
FROM incidents i JOIN districts d ON i.neighbourhood = d.neighbourhood
WHERE i.year IN ({_YEARS_IN})
  AND d.district IN (SELECT d2.district FROM incidents i2 JOIN districts d2 ON i2.neighbourhood = d2.neighbourhood
                     WHERE i2.year IN ({_YEARS_IN}) GROUP BY d2.district HAVING count(DISTINCT i2.year) = {len(TEST_YEARS)})
GROUP BY d.district, i.year
""")
def q_district_year_counts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = hotspots.district_year_counts(td.incidents(spark, sf_dir), td.district_dim(spark, sf_dir), TEST_YEARS)
    return dashboard.district_series(wide)


_TITLE_SQL = ("array_to_string(list_transform(string_split(neighbourhood, '-'), lambda p: "
              "array_to_string(list_transform(string_split(lower(p), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ')), '-')")


@register("least_district_top_blocks", _INC + f"""
, per AS (
  SELECT d.district, i.neighbourhood, i.hundred_block, i.year, count(*) AS n
  FROM incidents i JOIN districts d ON i.neighbourhood = d.neighbourhood
  WHERE {_LOOSE} AND i.year IN ({_YEARS_IN})
  GROUP BY d.district, i.neighbourhood, i.hundred_block, i.year)
, tot AS (SELECT district, sum(n) AS total FROM per GROUP BY district HAVING count(DISTINCT year) = {len(TEST_YEARS)})
, least AS (SELECT district FROM tot ORDER BY total, district LIMIT 1)
, blk AS (
  SELECT p.district, p.neighbourhood, p.hundred_block, sum(p.n) AS crime_count
  FROM per p JOIN least l ON p.district = l.district
  WHERE NOT (p.neighbourhood = '{TEST_EXCLUDE[0][0]}' AND p.hundred_block = '{TEST_EXCLUDE[0][1]}')
  GROUP BY p.district, p.neighbourhood, p.hundred_block)
, r AS (SELECT *, row_number() OVER (PARTITION BY neighbourhood ORDER BY crime_count DESC, hundred_block) AS rn FROM blk)
SELECT district, {_TITLE_SQL} AS neighbourhood, hundred_block, CAST(crime_count AS BIGINT) AS crime_count
FROM r WHERE rn = 1
""")
def q_least_district_top_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots.least_district_top_blocks(td.incidents(spark, sf_dir), td.district_dim(spark, sf_dir),
                                              TEST_YEARS, exclude=TEST_EXCLUDE)


@register("district_points", _INC + f"""
SELECT i.x, i.y FROM incidents i JOIN districts d ON i.neighbourhood = d.neighbourhood
WHERE d.district = {TEST_DISTRICT} AND i.year IN ({_YEARS_IN}) AND {_LOOSE}
""")
def q_district_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots.district_points(td.incidents(spark, sf_dir), td.district_dim(spark, sf_dir),
                                    TEST_DISTRICT, TEST_YEARS)


_BLOCKS_IN = ", ".join(f"'{b}'" for b in TEST_BLOCKS)


@register("hot_block_points", _INC + f"""
SELECT i.x, i.y FROM incidents i JOIN districts d ON i.neighbourhood = d.neighbourhood
WHERE d.district = {TEST_DISTRICT} AND i.year IN ({_YEARS_IN}) AND {_LOOSE}
  AND i.hundred_block IN ({_BLOCKS_IN})
""")
def q_hot_block_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots.hot_block_points(td.incidents(spark, sf_dir), td.district_dim(spark, sf_dir),
                                     TEST_DISTRICT, TEST_BLOCKS, TEST_YEARS)


# ----------------------------------------------------------------- rollups
def _rollup_sql(cols: str, source: str = "incidents") -> str:
    return f"SELECT {cols}, count(*) AS count FROM {source} GROUP BY {cols}"


for _grain in ("type", "neighbourhood", "month", "type_neighbourhood"):
    def _make(grain: str) -> QueryFn:
        def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rollups.rollup(td.incidents(spark, sf_dir), grain)
        fn.__name__ = f"q_rollup_{grain}"
        return fn
    register(f"rollup_{_grain}", _INC + _rollup_sql(", ".join(rollups.ROLLUP_GRAINS[_grain])))(_make(_grain))


@register("rollup_hour", td.with_ctes(td.HOURLY_SQL) + _rollup_sql("year, hour", "hourly"))
def q_rollup_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.rollup(td.hourly_incidents(spark, sf_dir), "hour")


def _gs_branch(grain: str) -> str:
    cols = rollups.ROLLUP_GRAINS[grain]
    sel = ", ".join(c if c in cols else f"NULL AS {c}" for c in ("year", "type", "neighbourhood", "month", "hour"))
    return f"SELECT '{grain}' AS grain, {sel}, count(*) AS count FROM incidents GROUP BY {', '.join(cols)}"


@register("rollup_grouping_sets", _INC + "\nUNION ALL\n".join(_gs_branch(g) for g in rollups.ROLLUP_GRAINS))
def q_rollup_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.rollup_grouping_sets(td.incidents(spark, sf_dir))


@register("union_by_name", _INC + "\nUNION ALL\n".join(_gs_branch(g) for g in rollups.ROLLUP_GRAINS))
def q_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rollups (from one base aggregate) stacked by column name."""
    return rollups.rollups_long(rollups.rollups(td.incidents(spark, sf_dir)))


@register("rollups_from_base", _INC + """
SELECT year, type, neighbourhood, count(*) AS count FROM incidents GROUP BY year, type, neighbourhood
""")
def q_rollups_from_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type x neighbourhood table derived from the single base aggregate."""
    return rollups.rollups(td.incidents(spark, sf_dir))["type_neighbourhood"]


@register("distinct_counts", _INC + """
SELECT count(DISTINCT type) AS n_distinct_type, count(DISTINCT neighbourhood) AS n_distinct_neighbourhood,
       count(DISTINCT hundred_block) AS n_distinct_hundred_block FROM incidents
""")
def q_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.distinct_counts(td.incidents(spark, sf_dir), ["type", "neighbourhood", "hundred_block"])


@register("value_counts", _INC + "SELECT type AS value, count(*) AS count FROM incidents GROUP BY type")
def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.value_counts(td.incidents(spark, sf_dir), "type")


_SUMMARY_TYPES = (("id", "string"), ("type", "string"), ("timestamp", "timestamp_ntz"), ("year", "int"),
                  ("month", "int"), ("day", "int"), ("hour", "int"), ("minute", "int"),
                  ("neighbourhood", "string"), ("x_neighbourhood", "double"), ("y_neighbourhood", "double"),
                  ("hundred_block", "string"), ("x", "double"), ("y", "double"))


@register("table_summary", _INC + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(\"{c}\") AS non_null, '{t}' AS data_type FROM incidents"
    for c, t in _SUMMARY_TYPES))
def q_table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.table_summary(td.incidents(spark, sf_dir))


@register("any_zero_coordinate", _INC + """
SELECT coalesce(bool_or(x = 0), false) AS any_zero_x, coalesce(bool_or(y = 0), false) AS any_zero_y FROM incidents
""")
def q_any_zero_coordinate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.any_zero(td.incidents(spark, sf_dir), ["x", "y"])


# --------------------------------------------------------------- dashboard
DASH_YEAR = 1998


@register("dashboard_type_totals", _INC + f"""
SELECT type, count(*) AS total FROM incidents WHERE year = {DASH_YEAR} GROUP BY type
""")
def q_dashboard_type_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.type_totals(rollups.rollup(td.incidents(spark, sf_dir), "type"), DASH_YEAR)


@register("dashboard_neighbourhood_totals", _INC + f"""
SELECT neighbourhood, count(*) AS total FROM incidents WHERE year = {DASH_YEAR} GROUP BY neighbourhood
""")
def q_dashboard_neighbourhood_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.neighbourhood_totals(rollups.rollup(td.incidents(spark, sf_dir), "neighbourhood"), DASH_YEAR)


@register("dashboard_stacked", _INC + f"""
SELECT neighbourhood, type, count(*) AS count FROM incidents WHERE year = {DASH_YEAR} GROUP BY neighbourhood, type
""")
def q_dashboard_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.stacked(rollups.rollup(td.incidents(spark, sf_dir), "type_neighbourhood"), DASH_YEAR)


@register("dashboard_month_line", _INC + f"""
SELECT month, count(*) AS count FROM incidents WHERE year = {DASH_YEAR} GROUP BY month
""")
def q_dashboard_month_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.line(rollups.rollup(td.incidents(spark, sf_dir), "month"), DASH_YEAR, "month")


@register("dashboard_hour_line", td.with_ctes(td.HOURLY_SQL) + """
SELECT hour, count(*) AS count FROM hourly WHERE year = 2024 GROUP BY hour
""")
def q_dashboard_hour_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = td.hourly_incidents(spark, sf_dir)
    return dashboard.line(rollups.rollup(hourly, "hour"), 2024, "hour")


@register("dashboard_years", _INC + "SELECT DISTINCT year FROM incidents")
def q_dashboard_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.years(rollups.rollup(td.incidents(spark, sf_dir), "type"))


# ---------------------------------------------------------------- holidays
def _nth_monday_sql(month: int, n: str) -> str:
    d1 = f"make_date(year, {month}, 1)"
    return f"({d1} + CAST((8 - isodow({d1})) % 7 + 7 * ({n} - 1) AS INTEGER))"


_EASTER_SQL = """
easter AS (
  SELECT year, make_date(year, CAST(((h + l - 7 * m + 114) // 31) AS INTEGER),
                         CAST(((h + l - 7 * m + 114) % 31) + 1 AS INTEGER)) AS sunday
  FROM (SELECT year, h, l, (a + 11 * h + 22 * l) // 451 AS m
        FROM (SELECT year, a, h, (32 + 2 * e + 2 * i - h - k) % 7 AS l
              FROM (SELECT year, a, e, i, k, (19 * a + b - d - g + 15) % 30 AS h
                    FROM (SELECT year, year % 19 AS a, year // 100 AS b, year % 100 AS c,
                                 (year // 100) // 4 AS d, (year // 100) % 4 AS e,
                                 ((year // 100) - ((year // 100) + 8) // 25 + 1) // 3 AS g,
                                 (year % 100) // 4 AS i, (year % 100) % 4 AS k
                          FROM yrs)))))"""

CALENDAR_SQL = f"""
yrs AS (SELECT DISTINCT year FROM incidents WHERE year IS NOT NULL),
{_EASTER_SQL},
cal AS (
  SELECT make_date(year, 1, 1) AS date, 'New Year''s Day' AS holiday FROM yrs
  UNION ALL SELECT {_nth_monday_sql(2, "CASE WHEN year >= 2019 THEN 3 ELSE 2 END")}, 'Family Day' FROM yrs
  UNION ALL SELECT CAST(sunday - 2 AS DATE), 'Good Friday' FROM easter
  UNION ALL SELECT CAST(make_date(year, 5, 24) - CAST((isodow(make_date(year, 5, 24)) - 1) % 7 AS INTEGER) AS DATE),
                   'Victoria Day' FROM yrs
  UNION ALL SELECT make_date(year, 7, 1), 'Canada Day' FROM yrs
  UNION ALL SELECT {_nth_monday_sql(8, "1")}, 'Civic Holiday' FROM yrs
  UNION ALL SELECT {_nth_monday_sql(9, "1")}, 'Labour Day' FROM yrs
  UNION ALL SELECT make_date(year, 9, 30), 'National Day for Truth and Reconciliation' FROM yrs
  UNION ALL SELECT {_nth_monday_sql(10, "2")}, 'Thanksgiving' FROM yrs
  UNION ALL SELECT make_date(year, 11, 11), 'Remembrance Day' FROM yrs
  UNION ALL SELECT make_date(year, 12, 25), 'Christmas Day' FROM yrs
),
hd AS (
  SELECT i.year, c.holiday FROM incidents i
  JOIN cal c ON i.year = year(c.date) AND i.month = month(c.date) AND i.day = day(c.date)
)"""

RECENT_SINCE = 1999


def _calendar_for(incidents: DataFrame) -> DataFrame:
    return holidays.statutory_calendar(incidents)


_FAR = td.with_ctes(td.FAR_YEARS_SQL)


@register("holiday_calendar", _FAR + "," + CALENDAR_SQL + "\nSELECT CAST(date AS DATE) AS date, holiday FROM cal")
def q_holiday_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calendar_for(td.far_year_incidents(spark, sf_dir))


@register("holiday_top3_by_year", _FAR + "," + CALENDAR_SQL + """
, per AS (SELECT holiday, year, count(*) AS count FROM hd GROUP BY holiday, year)
, top AS (SELECT holiday FROM per GROUP BY holiday ORDER BY sum(count) DESC, holiday LIMIT 3)
SELECT year, count, holiday FROM per WHERE holiday IN (SELECT holiday FROM top)
""")
def q_holiday_top3_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return holidays.holiday_top_by_year(td.far_year_incidents(spark, sf_dir), k=3)


@register("holiday_top3_recent", _FAR + "," + CALENDAR_SQL + f"""
SELECT holiday, count(*) AS count FROM hd WHERE year >= {RECENT_SINCE}
GROUP BY holiday ORDER BY count DESC, holiday LIMIT 3
""")
def q_holiday_top3_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return holidays.holiday_ranking(td.far_year_incidents(spark, sf_dir), k=3, since_year=RECENT_SINCE)


@register("holiday_share", _FAR + "," + CALENDAR_SQL + """
SELECT count(*) AS incidents,
       count(*) FILTER (WHERE EXISTS (SELECT 1 FROM cal c WHERE year(c.date) = i.year AND month(c.date) = i.month
                                      AND day(c.date) = i.day)) AS on_holidays,
       (count(*) FILTER (WHERE EXISTS (SELECT 1 FROM cal c WHERE year(c.date) = i.year AND month(c.date) = i.month
                                       AND day(c.date) = i.day)))::DOUBLE / count(*) AS share
FROM incidents i
""")
def q_holiday_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return holidays.holiday_share(td.far_year_incidents(spark, sf_dir))


# ---------------------------------------------------------------- cleaning
def _clean_block_sql(b: str) -> str:
    """Block-name cleaning chain in DuckDB SQL (independent formulation)."""
    unq = f"(CASE WHEN starts_with({b}, '\"') THEN split_part(substr({b}, 2), '\"', 1) ELSE {b} END)"
    unmask = (f"array_to_string(list_filter(string_split({unq}, ' '), lambda w: NOT ((regexp_matches(w, '^[0-9]') "
              f"AND contains(w, 'x')) OR w = 'x')), ' ')")
    alias = f"split_part({unmask}, '/', 1)"
    digits = "(CASE WHEN ltrim(w, '0') = '' THEN '0' ELSE ltrim(w, '0') END)"
    t = f"CAST(right({digits}, 2) AS INTEGER)"
    suffix = (f"(CASE WHEN {t} % 100 BETWEEN 11 AND 13 THEN 'th' WHEN {t} % 10 = 1 THEN 'st' "
              f"WHEN {t} % 10 = 2 THEN 'nd' WHEN {t} % 10 = 3 THEN 'rd' ELSE 'th' END)")
    norm = (f"array_to_string(list_transform(string_split({alias}, ' '), lambda w: CASE WHEN w = 'av' THEN 'ave' "
            f"WHEN regexp_matches(w, '^[0-9]+$') THEN {digits} || {suffix} ELSE w END), ' ')")
    return f"array_to_string(list_filter(string_split({norm}, ' '), lambda w: w <> 'xxxx'), ' ')"


def _utm_sql(e: str, n: str) -> tuple[str, str]:
    """Inverse transverse Mercator (zone 10 north) in DuckDB SQL."""
    import math
    n1 = 1 / (2 * 298.257223563 - 1)  # third flattening f / (2 - f)
    # Rectifying radius and the Krueger coefficients to order 4, as published.
    k0a = 0.9996 * 6378137.0 / (1 + n1) * (1 + n1**2 / 4 + n1**4 / 64)
    beta = (n1 / 2 - 2 * n1**2 / 3 + 37 * n1**3 / 96 - n1**4 / 360, n1**2 / 48 + n1**3 / 15 - 437 * n1**4 / 1440,
            17 * n1**3 / 480 - 37 * n1**4 / 840, 4397 * n1**4 / 161280)
    delta = (2 * n1 - 2 * n1**2 / 3 - 2 * n1**3 + 116 * n1**4 / 45, 7 * n1**2 / 3 - 8 * n1**3 / 5 - 227 * n1**4 / 45,
             56 * n1**3 / 15 - 136 * n1**4 / 35, 4279 * n1**4 / 630)
    xi = f"(({n}) / {k0a!r})"
    eta = f"((({e}) - 500000.0) / {k0a!r})"

    def sinh(x: str) -> str:
        return f"((exp({x}) - exp(-({x}))) / 2)"

    def cosh(x: str) -> str:
        return f"((exp({x}) + exp(-({x}))) / 2)"
    xi_p = xi + "".join(f" - {b!r} * sin({2 * j} * {xi}) * {cosh(f'{2 * j} * {eta}')}"
                        for j, b in enumerate(beta, start=1))
    eta_p = eta + "".join(f" - {b!r} * cos({2 * j} * {xi}) * {sinh(f'{2 * j} * {eta}')}"
                          for j, b in enumerate(beta, start=1))
    chi = f"asin(sin({xi_p}) / {cosh(eta_p)})"
    phi = chi + "".join(f" + {d!r} * sin({2 * j} * {chi})" for j, d in enumerate(delta, start=1))
    lam = f"({math.radians(10 * 6 - 183)!r} + atan2({sinh(eta_p)}, cos({xi_p})))"
    ok = f"(({e}) BETWEEN 100000 AND 1000000 AND ({n}) BETWEEN 0 AND 10000000)"
    return (f"CASE WHEN {ok} THEN degrees({phi}) END", f"CASE WHEN {ok} THEN degrees({lam}) END")


def _dec6(c):
    return F.round(c, 6).cast("decimal(12,6)")


_LAT_SQL, _LON_SQL = _utm_sql("e", "n")

CLEAN_SQL = td.with_ctes(td.RAW_SQL, td.POINTS_SQL) + f"""
, d AS (
  SELECT DISTINCT * FROM raw
  WHERE type IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL AND hour IS NOT NULL
    AND minute IS NOT NULL AND hundred_block IS NOT NULL AND neighbourhood IS NOT NULL
    AND x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y))
, l AS (
  SELECT sha256(array_to_string(list_transform(
                [type, CAST(year AS VARCHAR), CAST(month AS VARCHAR), CAST(day AS VARCHAR), CAST(hour AS VARCHAR),
                 CAST(minute AS VARCHAR), hundred_block, neighbourhood, CAST(x AS VARCHAR), CAST(y AS VARCHAR)],
                lambda v: CAST(length(v) AS VARCHAR) || ':' || v), '')) AS id,
         lower(type) AS type, year, month, day, hour, minute, lower(hundred_block) AS hb,
         lower(neighbourhood) AS neighbourhood, x AS e, y AS n
  FROM d WHERE x <> 0 OR y <> 0)
SELECT l.id, l.type,
       CASE WHEN l.month BETWEEN 1 AND 12 AND l.day BETWEEN 1 AND day(last_day(make_date(l.year, l.month, 1)))
                 AND l.hour BETWEEN 0 AND 23 AND l.minute BETWEEN 0 AND 59
            THEN make_timestamp(l.year, l.month, l.day, l.hour, l.minute, 0) END AS "timestamp",
       l.year, l.month, l.day, l.hour, l.minute, l.neighbourhood,
       p.lat AS x_neighbourhood, p.lon AS y_neighbourhood,
       {_clean_block_sql('l.hb')} AS hundred_block,
       CAST(round({_LAT_SQL}, 6) AS DECIMAL(12, 6)) AS x,
       CAST(round({_LON_SQL}, 6) AS DECIMAL(12, 6)) AS y
FROM l LEFT JOIN pts p ON l.neighbourhood = p.neighbourhood
"""


@register("clean_incidents", CLEAN_SQL)
def q_clean_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full cleaning job; positions compared at 6 decimals (about 0.1 m)."""
    clean = cleaning.clean_incidents(td.raw_incidents(spark, sf_dir), td.point_dim(spark, sf_dir))
    return clean.withColumns({"x": _dec6(F.col("x")), "y": _dec6(F.col("y"))})


@register("clean_blocks", td.with_ctes(td.RAW_SQL) + f"""
, b AS (SELECT DISTINCT hundred_block AS raw_block FROM raw WHERE hundred_block IS NOT NULL)
SELECT raw_block, {_clean_block_sql('lower(raw_block)')} AS hundred_block FROM b
""")
def q_clean_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = td.raw_incidents(spark, sf_dir).select(F.col("hundred_block").alias("raw_block")).dropna().distinct()
    return raw.select("raw_block", text.clean_block(F.lower("raw_block")).alias("hundred_block"))


@register("clean_timestamps", td.with_ctes(td.TIMESTAMP_PARTS_SQL) + """
SELECT l_orderkey, l_linenumber,
       CASE WHEN month BETWEEN 1 AND 12 AND day BETWEEN 1 AND day(last_day(make_date(year, month, 1)))
                 AND hour BETWEEN 0 AND 23 AND minute BETWEEN 0 AND 59
            THEN make_timestamp(year, month, day, hour, minute, 0) END AS "timestamp"
FROM parts
""")
def q_clean_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = td.timestamp_parts(spark, sf_dir)
    return p.select("l_orderkey", "l_linenumber",
                    timefn.incident_timestamp("year", "month", "day", "hour", "minute").alias("timestamp"))


@register("fractional_hours", td.with_ctes(td.TIMESTAMP_PARTS_SQL) + """
SELECT l_orderkey, l_linenumber, hour + minute / 60.0::DOUBLE AS hours FROM parts
""")
def q_fractional_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = td.timestamp_parts(spark, sf_dir)
    return p.select("l_orderkey", "l_linenumber", timefn.fractional_hour("hour", "minute").alias("hours"))


_PLAT, _PLON = _utm_sql("easting", "northing")


@register("project_points", td.with_ctes(td.UTM_POINTS_SQL) + f"""
SELECT s_suppkey, CAST(round({_PLAT}, 6) AS DECIMAL(12, 6)) AS lat, CAST(round({_PLON}, 6) AS DECIMAL(12, 6)) AS lon
FROM utm
""")
def q_project_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = td.utm_points(spark, sf_dir)
    lat, lon = geo.utm_to_latlon("easting", "northing", zone=10, northern=True)
    return p.select("s_suppkey", _dec6(lat).alias("lat"), _dec6(lon).alias("lon"))


# ---------------------------------------------------------- classification
KNN_K = 25
KNN_TRAIN_PERCENT = 67
KNN_EXCLUDE = ("5-low",)
KNN_FEATURES = ["year", "month", "hour", "nbr", "hb"]


def _encoded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows with alphabetical codes: ``label``, ``nbr``, ``hb``."""
    rows = classify.training_rows(td.incidents(spark, sf_dir), include=None, exclude=KNN_EXCLUDE,
                                  strict_coordinates=True)
    tables = classify.label_tables(rows, ["target", "neighbourhood", "hundred_block"])
    rows = classify.encode(rows, "target", tables["target"], "label")
    rows = classify.encode(rows, "neighbourhood", tables["neighbourhood"], "nbr")
    rows = classify.encode(rows, "hundred_block", tables["hundred_block"], "hb")
    return rows.withColumn("bucket", classify.split_bucket("id"))


def _knn_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Encoded rows feed the training side, the queries and the label
    # decoding: written once to the checkpoint folder instead of recomputed.
    rows = cut_lineage(_encoded_rows(spark, sf_dir))
    train = rows.filter(F.col("bucket") < KNN_TRAIN_PERCENT)
    test = rows.filter(F.col("bucket") >= KNN_TRAIN_PERCENT)
    pred = knn.knn_predict(train, test, KNN_FEATURES, "label", k=KNN_K)
    labels = rows.select(F.col("label").alias("prediction"), F.col("target").alias("predicted")).distinct()
    return pred.join(dims.broadcast_checked(labels), "prediction", "left").select("id", "target", "predicted")


_ROWS_SQL = f"""
rows AS (
  SELECT id, year, month, hour, neighbourhood, hundred_block, type AS target FROM incidents
  WHERE id IS NOT NULL AND type IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL AND hour IS NOT NULL
    AND neighbourhood IS NOT NULL AND hundred_block IS NOT NULL
    AND x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)
    AND type NOT IN ({", ".join(f"'{c}'" for c in KNN_EXCLUDE)}) AND x <> 0 AND y <> 0),
enc AS (
  SELECT r.*, CAST(dense_rank() OVER (ORDER BY target) - 1 AS INTEGER) AS label,
         CAST(dense_rank() OVER (ORDER BY neighbourhood) - 1 AS INTEGER) AS nbr,
         CAST(dense_rank() OVER (ORDER BY hundred_block) - 1 AS INTEGER) AS hb,
         (('0x' || substr(md5(id), 1, 8))::BIGINT) % 100 AS bucket
  FROM rows r)"""

_KNN_SQL = _ROWS_SQL + f""",
train AS (SELECT year, month, hour, nbr, hb, label, count(*) AS w FROM enc WHERE bucket < {KNN_TRAIN_PERCENT}
          GROUP BY year, month, hour, nbr, hb, label),
q AS (SELECT DISTINCT year AS qy, month AS qm, hour AS qh, nbr AS qn, hb AS qb FROM enc WHERE bucket >= {KNN_TRAIN_PERCENT}),
ranked AS (
  SELECT q.*, t.*, row_number() OVER (PARTITION BY qy, qm, qh, qn, qb
         ORDER BY (qy - t.year) * (qy - t.year) + (qm - t.month) * (qm - t.month) + (qh - t.hour) * (qh - t.hour)
                  + (qn - t.nbr) * (qn - t.nbr) + (qb - t.hb) * (qb - t.hb), t.year, t.month, t.hour, t.nbr, t.hb,
                  t.label) AS rn
  FROM q CROSS JOIN train t
  QUALIFY rn <= {KNN_K}),
cum AS (SELECT *, sum(w) OVER (PARTITION BY qy, qm, qh, qn, qb ORDER BY rn) AS c FROM ranked),
votes AS (SELECT qy, qm, qh, qn, qb, label, sum(greatest(0, least(w, {KNN_K} - (c - w)))) AS v FROM cum
          GROUP BY qy, qm, qh, qn, qb, label HAVING v > 0),
best AS (SELECT *, row_number() OVER (PARTITION BY qy, qm, qh, qn, qb ORDER BY v DESC, label) AS r FROM votes QUALIFY r = 1),
labels AS (SELECT DISTINCT target AS predicted, label FROM enc),
knn AS (
  SELECT e.id, e.target, l.predicted FROM enc e
  JOIN best b ON e.year = b.qy AND e.month = b.qm AND e.hour = b.qh AND e.nbr = b.qn AND e.hb = b.qb
  JOIN labels l ON l.label = b.label
  WHERE e.bucket >= {KNN_TRAIN_PERCENT})"""

_ML = _INC + "," + _KNN_SQL


@register("label_encode", _INC + "," + _ROWS_SQL + "\nSELECT DISTINCT neighbourhood AS value, nbr AS code FROM enc")
def q_label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify.training_rows(td.incidents(spark, sf_dir), include=None, exclude=KNN_EXCLUDE)
    return classify.label_table(rows, "neighbourhood")


@register("label_decode", _INC + "," + _ROWS_SQL + "\nSELECT id, hb, hundred_block AS decoded FROM enc")
def q_label_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify.training_rows(td.incidents(spark, sf_dir), include=None, exclude=KNN_EXCLUDE)
    table = classify.label_table(rows, "hundred_block")
    coded = classify.encode(rows.select("id", "hundred_block"), "hundred_block", table, "hb")
    return classify.decode(coded.select("id", "hb"), "hb", table, "decoded")


@register("frequency_encode", _INC + "," + _ROWS_SQL + f"""
, codes AS (SELECT hundred_block AS value, row_number() OVER (ORDER BY count(*) DESC, hundred_block) - 1 AS code FROM rows GROUP BY hundred_block)
SELECT r.id, CAST(c.code AS INTEGER) AS hundred_block_code FROM rows r JOIN codes c ON c.value = r.hundred_block
""")
def q_frequency_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes by falling frequency, numbered by range partitioning and partition offsets."""
    rows = classify.training_rows(td.incidents(spark, sf_dir), include=None, exclude=KNN_EXCLUDE)
    table = classify.frequency_table(rows, "hundred_block")
    return classify.encode(rows.select("id", "hundred_block"), "hundred_block", table).select("id", "hundred_block_code")


@register("knn_category", _ML + "\nSELECT id, target, predicted FROM knn")
def q_knn_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn_predictions(spark, sf_dir)


@register("confusion_matrix", _ML + "\nSELECT target AS label, predicted AS prediction, count(*) AS count FROM knn GROUP BY ALL")
def q_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_knn_predictions(spark, sf_dir), "target", "predicted")


_KNN_CLASSES = ("1-urgent", "2-high", "3-medium", "4-not specified")  # target values left after KNN_EXCLUDE


@register("confusion_matrix_wide", _ML + "\nSELECT target AS label, " + ", ".join(
    f"count(*) FILTER (WHERE predicted = '{c}') AS \"{c}\"" for c in _KNN_CLASSES) + " FROM knn GROUP BY target")
def q_confusion_matrix_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True label x predicted label, one column per class (pivot)."""
    return metrics.confusion_matrix(_knn_predictions(spark, sf_dir), "target", "predicted")


@register("classification_report", _ML + """
, c AS (SELECT target, predicted, count(*) AS n FROM knn GROUP BY ALL)
, cls AS (SELECT target AS label FROM c UNION SELECT predicted FROM c)
, s AS (SELECT cls.label,
               coalesce((SELECT sum(n) FROM c WHERE c.target = cls.label AND c.predicted = cls.label), 0) AS tp,
               coalesce((SELECT sum(n) FROM c WHERE c.target = cls.label), 0) AS support,
               coalesce((SELECT sum(n) FROM c WHERE c.predicted = cls.label), 0) AS predicted
        FROM cls)
, pr AS (SELECT label, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
                CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM s)
SELECT label, precision, recall,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
       CAST(support AS BIGINT) AS support
FROM pr
""")
def q_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.classification_report(_knn_predictions(spark, sf_dir), "target", "predicted")


@register("accuracy", _ML + """
SELECT avg(CASE WHEN target = predicted THEN 1 ELSE 0 END) AS accuracy, count(*) AS n FROM knn
""")
def q_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.accuracy(_knn_predictions(spark, sf_dir), "target", "predicted")


RF_TARGETS = ("1-urgent", "2-high", "3-medium")


def _rf_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.training_rows(td.incidents(spark, sf_dir), include=RF_TARGETS, strict_coordinates=True)


_RF_SQL = _ROWS_SQL.replace(f"type NOT IN ({', '.join(repr(c) for c in KNN_EXCLUDE)})",
                            f"type IN ({', '.join(repr(c) for c in RF_TARGETS)})")
_TRAIN_PERCENT = 80


@register("rf_train_score", _INC + "," + _RF_SQL + f"""
SELECT id, target, true AS scored FROM enc WHERE bucket >= {_TRAIN_PERCENT}
""")
def q_rf_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Spark ML forest's test rows; ``scored``: the prediction is one of the categories, and the forest's node table
    scored by joins gives the same one.  (The oracle of the predictions themselves is that of ``forest_train_score``, whose
    forest draws its samples in a way that SQL can repeat.)"""
    trained = classify.train_category_model(_rf_rows(spark, sf_dir), classifier="rf", num_trees=10)
    nodes = forest.nodes_of(spark, trained.model.stages[3], _scratch(spark, "forest"))
    features = [*classify.NUMERIC_FEATURES, "indexedNbr", "indexedHb"]
    rows = trained.predictions.select("id", "target", "predictedLabel", "prediction", *features)
    both = forest.score(rows, nodes, features, "by_table")
    known = F.col("predictedLabel").isin(list(RF_TARGETS))
    return both.select("id", "target", (known & (F.col("by_table") == F.col("prediction"))).alias("scored"))


def _frequency_index(column: str) -> str:
    """Codes by falling frequency, equal ones by name, as the string indexer gives them."""
    return (f"SELECT {column} AS v, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS i FROM rows "
            f"GROUP BY {column}")


_NB_SQL = _INC + "," + _RF_SQL + f""",
nl AS ({_frequency_index("neighbourhood")}), bl AS ({_frequency_index("hundred_block")}), tl AS ({_frequency_index("target")}),
x AS (
  SELECT e.id, e.target, e.bucket, tl.i AS label, e.year::DOUBLE AS f1, e.month::DOUBLE AS f2, e.hour::DOUBLE AS f3,
         nl.i::DOUBLE AS f4, bl.i::DOUBLE AS f5
  FROM enc e JOIN nl ON nl.v = e.neighbourhood JOIN bl ON bl.v = e.hundred_block JOIN tl ON tl.v = e.target),
s AS (
  SELECT label, any_value(target) AS said, count(*) AS n, sum(f1) AS s1, sum(f2) AS s2, sum(f3) AS s3, sum(f4) AS s4, sum(f5) AS s5
  FROM x WHERE bucket < {_TRAIN_PERCENT} GROUP BY label),
w AS (
  SELECT label, said, ln(n + 1.0) - ln((SELECT sum(n) + count(*) FROM s)) AS p,
         ln(s1 + 1) - ln(s1 + s2 + s3 + s4 + s5 + 5) AS w1, ln(s2 + 1) - ln(s1 + s2 + s3 + s4 + s5 + 5) AS w2,
         ln(s3 + 1) - ln(s1 + s2 + s3 + s4 + s5 + 5) AS w3, ln(s4 + 1) - ln(s1 + s2 + s3 + s4 + s5 + 5) AS w4,
         ln(s5 + 1) - ln(s1 + s2 + s3 + s4 + s5 + 5) AS w5
  FROM s),
nb AS (
  SELECT x.id, x.target, arg_max(w.said, p + f1 * w1 + f2 * w2 + f3 * w3 + f4 * w4 + f5 * w5) AS "predictedLabel"
  FROM x CROSS JOIN w WHERE x.bucket >= {_TRAIN_PERCENT} GROUP BY x.id, x.target)"""


@register("nb_train_score", _NB_SQL + '\nSELECT id, target, "predictedLabel" FROM nb')
def q_nb_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multinomial naive Bayes, smoothing 1.0 (closed form in the oracle)."""
    trained = classify.train_category_model(_rf_rows(spark, sf_dir), classifier="nb")
    return trained.predictions.select("id", "target", "predictedLabel")


@register("unpredicted_classes", _NB_SQL + """
SELECT DISTINCT target AS label FROM nb WHERE target NOT IN (SELECT "predictedLabel" FROM nb)
""")
def q_unpredicted_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories that naive Bayes never predicts."""
    trained = classify.train_category_model(_rf_rows(spark, sf_dir), classifier="nb")
    return metrics.unpredicted_classes(trained.predictions, "target", "predictedLabel")


@register("rf_metrics", _INC + "," + _RF_SQL + f"""
SELECT count(*) AS n, true AS accuracy_agrees, true AS recall_agrees, true AS f1_agrees FROM enc WHERE bucket >= {_TRAIN_PERCENT}
""")
def q_rf_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluators' metrics of the forest against the metrics aggregated
    from its predictions."""
    trained = classify.train_category_model(_rf_rows(spark, sf_dir), classifier="rf", num_trees=10)
    pred = cut_lineage(trained.predictions.select("target", "predictedLabel", "indexedLabel", "prediction"))
    told = classify.evaluate(pred)
    share = F.col("support") / F.sum("support").over(Window.partitionBy())  # one row per class
    report = metrics.classification_report(pred, "target", "predictedLabel").withColumn("share", share)
    own = report.agg(F.sum(F.col("recall") * F.col("share")).alias("_recall"), F.sum(F.col("f1") * F.col("share")).alias("_f1"))
    counted = metrics.accuracy(pred, "target", "predictedLabel").withColumnRenamed("accuracy", "_accuracy")
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) < 1e-9
    rows = told.unionByName(own, allowMissingColumns=True).unionByName(counted, allowMissingColumns=True)  # three rows
    both = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    return both.select("n", near("accuracy", "_accuracy").alias("accuracy_agrees"),
                       near("weightedRecall", "_recall").alias("recall_agrees"), near("f1", "_f1").alias("f1_agrees"))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every incident as a request; some lack a field, some name an unknown place."""
    k = F.col("id").cast("bigint")
    return td.incidents(spark, sf_dir).select(
        F.col("id").alias("request_id"), "year", F.when(k % 61 != 0, F.col("month")).alias("month"), "hour",
        F.when(k % 67 == 0, F.lit("nowhere")).when(k % 71 != 0, F.col("neighbourhood")).alias("neighbourhood"),
        F.when(k % 73 == 0, F.lit("no such block")).otherwise(F.col("hundred_block")).alias("hundred_block"))


@register("score_requests", _INC + f"""
, req AS (
  SELECT id AS request_id, CASE WHEN CAST(id AS BIGINT) % 61 <> 0 THEN month END AS month,
         CASE WHEN CAST(id AS BIGINT) % 67 = 0 THEN 'nowhere' WHEN CAST(id AS BIGINT) % 71 <> 0 THEN neighbourhood END AS neighbourhood,
         CASE WHEN CAST(id AS BIGINT) % 73 = 0 THEN 'no such block' ELSE hundred_block END AS hundred_block FROM incidents)
, seen AS (SELECT neighbourhood, hundred_block FROM incidents
           WHERE type IN ({", ".join(f"'{c}'" for c in RF_TARGETS)}) AND x <> 0 AND y <> 0)
, st AS (
  SELECT request_id, CASE WHEN month IS NULL OR neighbourhood IS NULL THEN 'missing_input'
         WHEN neighbourhood NOT IN (SELECT neighbourhood FROM seen) OR hundred_block NOT IN (SELECT hundred_block FROM seen)
         THEN 'unknown_input' ELSE 'ok' END AS status FROM req)
SELECT request_id, status, status = 'ok' AS predicted FROM st
""")
def q_score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, save the pipeline under the shared checkpoint folder, load it
    back and score every incident as a request; ``predicted``: whether the
    request got one of the categories (capitalised)."""
    trained = classify.train_category_model(_rf_rows(spark, sf_dir), classifier="rf", num_trees=10)
    path = _scratch(spark, "category-model")
    classify.save(trained.model, path)
    scored = classify.score_requests(classify.load(path), _requests(spark, sf_dir))
    names = [c.capitalize() for c in RF_TARGETS]
    return scored.select("request_id", "status", F.col("prediction").isin(names).alias("predicted"))


FOREST_TREES, FOREST_DEPTH, FOREST_TRIED = 10, 5, 3


def _purity(side: str) -> str:
    a, b, c = (f"CAST({side}{k} AS DOUBLE)" for k in range(3))
    return f"(({a} * {a} + {b} * {b}) + {c} * {c}) / (({a} + {b}) + {c})"


def _forest_level(n: int) -> str:
    """One level in SQL: class counts by tried feature and value, the best split of every node, and the rows below it."""
    windows = ("WINDOW g AS (PARTITION BY tree, node, feature), "
               "u AS (PARTITION BY tree, node, feature ORDER BY value ROWS UNBOUNDED PRECEDING)")
    sums = ", ".join(f"sum(CASE WHEN y = {k} THEN w ELSE 0 END) AS c{k}" for k in range(3))
    upto = ", ".join(f"sum(c{k}) OVER u AS l{k}, sum(c{k}) OVER g AS t{k}, sum(c{k}) OVER g - sum(c{k}) OVER u AS r{k}" for k in range(3))
    down = "CASE WHEN b.feature IS NULL THEN m.node WHEN m.f[b.feature + 1] <= b.threshold THEN 2 * m.node + 1 ELSE 2 * m.node + 2 END"
    return f"""
tried{n} AS (
  SELECT tree, node, feature FROM (SELECT DISTINCT tree, node FROM m{n}) CROSS JOIN (SELECT unnest(range(5)) AS feature)
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY md5(tree || '/' || node || '/' || feature), feature) <= {FOREST_TRIED}),
hist{n} AS (
  SELECT m.tree, m.node, t.feature, m.f[t.feature + 1] AS value, {sums}
  FROM m{n} m JOIN tried{n} t ON m.tree = t.tree AND m.node = t.node GROUP BY m.tree, m.node, t.feature, m.f[t.feature + 1]),
side{n} AS (SELECT tree, node, feature, value, {upto} FROM hist{n} {windows}),
gain{n} AS (SELECT *, {_purity("l")} + {_purity("r")} AS score, {_purity("t")} AS before FROM side{n} WHERE r0 + r1 + r2 > 0),
b{n} AS MATERIALIZED (
  SELECT tree, node, feature, value AS threshold FROM gain{n} WHERE score > before * (1 + 1e-12)
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY score DESC, feature, value) = 1),
m{n + 1} AS MATERIALIZED (
  SELECT m.tree, {down} AS node, m.y, m.f, m.w FROM m{n} m LEFT JOIN b{n} b ON m.tree = b.tree AND m.node = b.node)"""


def _forest_scored(source: str, key: str) -> str:
    """Rows of ``source`` (``key``, features ``f``) down all trees; ``said``: the category with most votes."""
    at = f"(SELECT s.{key}, s.f, t.tree, CAST(0 AS BIGINT) AS node FROM {source} s CROSS JOIN (SELECT unnest(range({FOREST_TREES})) AS tree) t)"
    for n in range(FOREST_DEPTH):
        at = (f"(SELECT m.{key}, m.f, m.tree, CASE WHEN b.feature IS NULL THEN m.node WHEN m.f[b.feature + 1] <= b.threshold "
              f"THEN 2 * m.node + 1 ELSE 2 * m.node + 2 END AS node FROM {at} m LEFT JOIN b{n} b ON m.tree = b.tree AND m.node = b.node)")
    votes = ", ".join(f"list_reduce(list(CAST(l.c{k} AS DOUBLE) / l.n ORDER BY l.tree), lambda a, b: a + b) AS v{k}" for k in range(3))
    return f"""
votes AS (SELECT x.{key}, {votes} FROM {at} x JOIN leaf l ON l.tree = x.tree AND l.node = x.node GROUP BY x.{key}),
said AS (SELECT v.{key}, tl.v AS said FROM votes v JOIN tl
         ON tl.i = CASE WHEN v0 >= v1 AND v0 >= v2 THEN 0 WHEN v1 >= v2 THEN 1 ELSE 2 END)"""


_DRAW = "(('0x' || substr(md5(c.id || '/' || t.tree), 1, 8))::BIGINT)"
_FOREST_SQL = _INC + "," + _RF_SQL + f""",
nl AS ({_frequency_index("neighbourhood")}), bl AS ({_frequency_index("hundred_block")}), tl AS ({_frequency_index("target")}),
coded AS MATERIALIZED (
  SELECT e.id, e.target, e.bucket, tl.i AS y,
         [CAST(e.year AS DOUBLE), CAST(e.month AS DOUBLE), CAST(e.hour AS DOUBLE), CAST(nl.i AS DOUBLE), CAST(bl.i AS DOUBLE)] AS f
  FROM enc e JOIN nl ON nl.v = e.neighbourhood JOIN bl ON bl.v = e.hundred_block JOIN tl ON tl.v = e.target),
drawn AS (
  SELECT t.tree, c.y, c.f, {" + ".join(f"(CASE WHEN {_DRAW} >= {step} THEN 1 ELSE 0 END)" for step in forest.poisson_steps())} AS w
  FROM coded c CROSS JOIN (SELECT unnest(range({FOREST_TREES})) AS tree) t WHERE c.bucket < {_TRAIN_PERCENT}),
m0 AS MATERIALIZED (SELECT tree, CAST(0 AS BIGINT) AS node, y, f, sum(w) AS w FROM drawn WHERE w > 0 GROUP BY tree, y, f),
{",".join(_forest_level(n) for n in range(FOREST_DEPTH))},
leaf AS MATERIALIZED (
  SELECT tree, node, sum(CASE WHEN y = 0 THEN w ELSE 0 END) AS c0, sum(CASE WHEN y = 1 THEN w ELSE 0 END) AS c1,
         sum(CASE WHEN y = 2 THEN w ELSE 0 END) AS c2, CAST(sum(w) AS DOUBLE) AS n FROM m{FOREST_DEPTH} GROUP BY tree, node)"""


def _forest(spark: SparkSession, sf_dir: str) -> forest.CategoryForest:
    return forest.train(_rf_rows(spark, sf_dir), trees=FOREST_TREES, depth=FOREST_DEPTH, train_percent=_TRAIN_PERCENT)


@register("forest_train_score", _FOREST_SQL + f""",
tested AS (SELECT id, target, f FROM coded WHERE bucket >= {_TRAIN_PERCENT}),
{_forest_scored("tested", "id")}
SELECT t.id, t.target, s.said AS predicted FROM tested t JOIN said s ON s.id = t.id
""")
def q_forest_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest grown by group-bys on the training rows, and the category it gives every test row."""
    rows = _rf_rows(spark, sf_dir)
    tested = rows.filter(classify.split_bucket("id") >= _TRAIN_PERCENT)
    return forest.predict(_forest(spark, sf_dir), tested).select("id", "target", "predicted")


@register("forest_table_score", _FOREST_SQL + ",\n" + " UNION ALL ".join([
    "split AS (SELECT tree, node, feature, threshold FROM b0",
    *[f"SELECT tree, node, feature, threshold FROM b{n}" for n in range(1, FOREST_DEPTH)]]) + f"""),
places AS (SELECT DISTINCT tree, node FROM (SELECT tree, node FROM split UNION ALL SELECT tree, node FROM leaf)),
held AS ({" UNION ".join(f"SELECT tree, node, sum(CASE WHEN y = 0 THEN w ELSE 0 END) AS c0, sum(CASE WHEN y = 1 THEN w ELSE 0 END) AS c1, "
                         f"sum(CASE WHEN y = 2 THEN w ELSE 0 END) AS c2 FROM m{n} GROUP BY tree, node" for n in range(FOREST_DEPTH + 1))})
SELECT CAST(p.tree AS INTEGER) AS tree, p.node, CAST(s.feature AS INTEGER) AS feature, s.threshold, CAST(h.c0 AS BIGINT) AS n0,
       CAST(h.c1 AS BIGINT) AS n1, CAST(h.c2 AS BIGINT) AS n2
FROM places p JOIN held h ON h.tree = p.tree AND h.node = p.node LEFT JOIN split s ON s.tree = p.tree AND s.node = p.node
""")
def q_forest_table_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node table of that forest: every split and the class counts of every node."""
    n = F.col("counts")
    return _forest(spark, sf_dir).nodes.select("tree", "node", "feature", "threshold", *[n[k].cast("long").alias(f"n{k}") for k in range(3)])


@register("forest_requests", _FOREST_SQL + f""",
req AS (
  SELECT id AS request_id, year, CASE WHEN CAST(id AS BIGINT) % 61 <> 0 THEN month END AS month, hour,
         CASE WHEN CAST(id AS BIGINT) % 67 = 0 THEN 'nowhere' WHEN CAST(id AS BIGINT) % 71 <> 0 THEN neighbourhood END AS neighbourhood,
         CASE WHEN CAST(id AS BIGINT) % 73 = 0 THEN 'no such block' ELSE hundred_block END AS hundred_block FROM incidents),
asked AS (
  SELECT r.request_id, CASE WHEN r.month IS NULL OR r.neighbourhood IS NULL THEN 'missing_input'
                            WHEN nl.i IS NULL OR bl.i IS NULL THEN 'unknown_input' ELSE 'ok' END AS status,
         [CAST(r.year AS DOUBLE), CAST(r.month AS DOUBLE), CAST(r.hour AS DOUBLE), CAST(nl.i AS DOUBLE), CAST(bl.i AS DOUBLE)] AS f
  FROM req r LEFT JOIN nl ON nl.v = r.neighbourhood LEFT JOIN bl ON bl.v = r.hundred_block),
fine AS (SELECT request_id, f FROM asked WHERE status = 'ok'),
{_forest_scored("fine", "request_id")}
SELECT a.request_id, a.status, CASE WHEN a.status = 'ok' THEN upper(s.said[1]) || lower(s.said[2:]) ELSE '' END AS prediction
FROM asked a LEFT JOIN said s ON s.request_id = a.request_id
""")
def q_forest_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest's tables saved, loaded back, and every incident scored as a request."""
    path = _scratch(spark, "forest-tables")
    forest.save(_forest(spark, sf_dir), path)
    return forest.score_requests(forest.load(spark, path), _requests(spark, sf_dir))


# ------------------------------------------------------ row selection, dims
_NOT_NULL_SQL = _ROWS_SQL[_ROWS_SQL.index("WHERE id IS NOT NULL"):_ROWS_SQL.index("AND type NOT IN")]


@register("training_rows_include", _INC + f"""
SELECT id, year, month, hour, neighbourhood, hundred_block, type AS target FROM incidents
{_NOT_NULL_SQL} AND type IN ({", ".join(f"'{c}'" for c in RF_TARGETS)}) AND x <> 0 AND y <> 0
""")
def q_training_rows_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category list, complete rows, both coordinates non-zero."""
    return _rf_rows(spark, sf_dir)


@register("training_rows_exclude", _INC + f"""
SELECT id, year, month, hour, neighbourhood, hundred_block, type AS target FROM incidents
{_NOT_NULL_SQL} AND type NOT IN ({", ".join(f"'{c}'" for c in KNN_EXCLUDE)}) AND hundred_block <> 'machinery 0'
  AND x <> 0 AND y <> 0
""")
def q_training_rows_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Excluded categories and an excluded block value."""
    return classify.training_rows(td.incidents(spark, sf_dir), include=None, exclude=KNN_EXCLUDE,
                                  drop_blocks=("machinery 0",))


@register("neighbourhood_centroids", _INC + """
SELECT neighbourhood, CAST(round(avg(x), 9) AS DECIMAL(13, 9)) AS lat, CAST(round(avg(y), 9) AS DECIMAL(13, 9)) AS lon
FROM incidents WHERE x <> 0 AND y <> 0 GROUP BY neighbourhood
""")
def q_neighbourhood_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroids compared at 1e-9 degrees: the order of a distributed sum is
    not fixed, so the last bits of a double average are not either."""
    c = dims.derived_point_dim(td.incidents(spark, sf_dir))
    return c.select("neighbourhood", *[F.round(col, 9).cast("decimal(13,9)").alias(col) for col in ("lat", "lon")])


# ------------------------------------------------------------ file formats
def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    import uuid

    from .session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files/{name}-{uuid.uuid4().hex}"


@register("csv_round_trip", td.with_ctes(td.RAW_SQL) + "SELECT * FROM raw")
def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-layout rows written as CSV with a header and read back with the
    explicit-schema, permissive raw reader (quotes, nulls and NaN survive)."""
    from .sources import files
    path = _scratch(spark, "raw-csv")
    files.write_csv(td.raw_incidents(spark, sf_dir), path)
    return files.read_raw_incidents(spark, path, own=True)


@register("clean_csv_round_trip", CLEAN_SQL)
def q_clean_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table (empty blocks, blocks with a trailing space, null
    points and times) written as CSV and read back unchanged."""
    from .sources import files
    path = _scratch(spark, "clean-csv")
    files.write_csv(cleaning.clean_incidents(td.raw_incidents(spark, sf_dir), td.point_dim(spark, sf_dir)), path)
    back = files.read_clean_incidents(spark, path, fmt="csv")
    return back.withColumns({"x": _dec6(F.col("x")), "y": _dec6(F.col("y"))})


@register("calendar_scan", _INC + "," + CALENDAR_SQL + "\nSELECT CAST(date AS DATE) AS date, holiday FROM cal")
def q_calendar_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the data's years written in the tab-separated layout
    (month abbreviation, MM/dd/yyyy, name, name) and read back with the
    calendar reader."""
    cal = _calendar_for(td.incidents(spark, sf_dir))
    path = _scratch(spark, "calendar-tsv")
    (cal.select(F.date_format("date", "MMM"), F.date_format("date", "MM/dd/yyyy"), "holiday", "holiday")
     .write.option("sep", "\t").option("header", False).csv(path))
    return holidays.read_calendar(spark, path)


@register("stream_rollup_base", _INC + """
SELECT year, month, hour, type, neighbourhood, count(*) AS count FROM incidents
GROUP BY year, month, hour, type, neighbourhood
""")
def q_stream_rollup_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole incident table dropped as two file sets (up to 1997, after
    1997) into a folder and folded in by the streaming rollup refresh;
    returns the refreshed base rollup."""
    from .sources import files
    from .streaming.rollups import rollup_stream
    root = _scratch(spark, "stream")
    inc = td.incidents(spark, sf_dir)
    files.write_parquet(inc.filter(F.col("year") <= 1997), f"{root}/in/batch-1")
    files.write_parquet(inc.filter(~(F.col("year") <= 1997) | F.col("year").isNull()), f"{root}/in/batch-2")
    out = f"{root}/out"

    def write(table: DataFrame, batch_id: int) -> None:
        table.write.mode("overwrite").parquet(out)

    query = rollup_stream(spark, f"{root}/in/*", write, checkpoint_location=f"{root}/ckpt", available_now=True)
    query.awaitTermination()
    return spark.read.parquet(out)


@register("stream_rollup_merge", _INC + """
SELECT year, month, hour, type, neighbourhood, count(*) AS count FROM incidents
GROUP BY year, month, hour, type, neighbourhood
""")
def q_stream_rollup_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole incident table dropped in three steps; after each, the micro-batches' counts are merged into the stored rollup."""
    from .sources import files
    from .streaming.rollups import rollup_merge_stream, stored_rollup
    root = _scratch(spark, "merge")
    inc = td.incidents(spark, sf_dir)
    early, late = F.col("year") <= 1996, F.col("year") > 1999
    for step, part in enumerate((early, ~early & ~late, late | F.col("year").isNull())):
        files.write_parquet(inc.filter(part), f"{root}/in/step-{step}")
        query = rollup_merge_stream(spark, f"{root}/in/*", f"{root}/out", f"{root}/ckpt", available_now=True)
        query.awaitTermination()
    return stored_rollup(spark, f"{root}/out")


@register("stream_clean_incidents", CLEAN_SQL)
def q_stream_clean_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows dropped in three steps, the later ones with rows of the earlier ones again; the cleaning job is started
    anew after each and appends what is new."""
    from .sources import files
    from .streaming.cleaning import clean_stream
    root = _scratch(spark, "clean")
    raw = td.raw_incidents(spark, sf_dir).withColumn("_step", F.pmod(F.xxhash64("type", "year", "month", "hundred_block", "x"), F.lit(4)))
    points = cut_lineage(td.point_dim(spark, sf_dir))
    for step, part in enumerate((F.col("_step") < 2, F.col("_step").between(1, 2), F.col("_step") >= 2)):
        files.write_parquet(raw.filter(part).drop("_step"), f"{root}/in/step-{step}")
        clean_stream(spark, f"{root}/in/*", f"{root}/out", f"{root}/ckpt", points, fmt="parquet").awaitTermination()
    out = files.read_clean_incidents(spark, f"{root}/out")
    return out.withColumns({"x": _dec6(F.col("x")), "y": _dec6(F.col("y"))})


# ----------------------------------------------------------- catalog tables
def _bucketed(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The incidents saved as a catalog table bucketed by block, read back by name."""
    import uuid

    from .sources import tables
    name = f"incidents_{uuid.uuid4().hex}"
    tables.save_bucketed(td.incidents(spark, sf_dir), name, buckets=8, path=_scratch(spark, name))
    return name, tables.read_table(spark, name)


@register("bucketed_hot_blocks", REGISTRY["district_year_hot_blocks"][1])
def q_bucketed_hot_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot blocks from the bucketed catalog table: the counts per (district, year, block) need no exchange."""
    _, inc = _bucketed(spark, sf_dir)
    return hotspots.district_year_hot_blocks(inc, td.district_dim(spark, sf_dir), after_year=HOT_AFTER_YEAR)


@register("bucketed_district_counts", REGISTRY["district_year_counts"][1])
def q_bucketed_district_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per district and year from the bucketed catalog table."""
    _, inc = _bucketed(spark, sf_dir)
    return hotspots.district_year_counts(inc, td.district_dim(spark, sf_dir), TEST_YEARS)


@register("bucketed_least_district", REGISTRY["least_district_top_blocks"][1])
def q_bucketed_least_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top blocks of the least district from the bucketed catalog table."""
    _, inc = _bucketed(spark, sf_dir)
    return hotspots.least_district_top_blocks(inc, td.district_dim(spark, sf_dir), TEST_YEARS, exclude=TEST_EXCLUDE)


@register("result_table_by_name", _INC + """
SELECT year, type, count(*) AS count FROM incidents GROUP BY year, type
""")
def q_result_table_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollup saved as a catalog table and read back by name, in display order."""
    import uuid

    from .sources import tables
    name = f"rollup_type_{uuid.uuid4().hex}"
    tables.save_result(rollups.rollup(td.incidents(spark, sf_dir), "type"), name, path=_scratch(spark, name))
    return tables.read_table(spark, name, order_by=["year", "type"])


# ----------------------------------------------------------------- sketches
_SKETCHED = ("type", "neighbourhood", "hundred_block", "id")


@register("distinct_sketches", _INC + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, count({c}) AS non_null, true AS within
    FROM incidents WHERE year BETWEEN {TEST_YEARS[0]} AND {TEST_YEARS[-1]}""" for c in _SKETCHED))
def q_distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct-count sketches stored per year, in two steps, and merged for three of the years; beside them the exact counts,
    and whether these lie within the stated range of the estimate."""
    inc, path = td.incidents(spark, sf_dir), _scratch(spark, "sketches")
    late = F.col("year") > TEST_YEARS[1]
    sketches.save_sketches(inc.filter(~late), _SKETCHED, path)
    sketches.save_sketches(inc.filter(late), _SKETCHED, path)
    told = sketches.distinct_estimates(sketches.stored_sketches(spark, path), (TEST_YEARS[0], TEST_YEARS[-1]))
    exact = rollups.distinct_counts(inc.filter(F.col("year").between(TEST_YEARS[0], TEST_YEARS[-1])), _SKETCHED)
    exact = exact.unpivot([], [f"n_distinct_{c}" for c in _SKETCHED], "_c", "n_distinct").select(
        F.substr("_c", F.lit(len("n_distinct_") + 1)).alias("column_name"), "n_distinct")
    return exact.join(F.broadcast(told), "column_name").select(
        "column_name", "n_distinct", "non_null", F.col("n_distinct").between(F.col("low"), F.col("high")).alias("within"))


TOP_BLOCKS = 20


@register("top_blocks", _INC + f"""
SELECT hundred_block AS value, count(*) AS count FROM incidents GROUP BY hundred_block
ORDER BY count(*) DESC, hundred_block LIMIT {TOP_BLOCKS}
""")
def q_top_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent blocks: bucket counts of two sets of years merged, then only values of full buckets are counted."""
    inc = td.incidents(spark, sf_dir)
    early = F.col("year") <= TEST_YEARS[0]
    parts = [sketches.bucket_counts(inc.filter(p), "hundred_block") for p in (early, ~early)]
    return sketches.top_values(inc, "hundred_block", TOP_BLOCKS, counts=sketches.merged_counts(parts))


# ------------------------------------------- readers, maps and single files
_INFERRED = {"type": "string", "year": "int", "month": "int", "day": "int", "hour": "int", "minute": "int", "neighbourhood": "string",
             "x": "double", "y": "double"}


@register("inferred_csv", td.with_ctes(td.RAW_SQL) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, '{t}' AS data_type FROM raw" for c, t in _INFERRED.items()))
def q_inferred_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows as a plain CSV with a header, read back with inferred types: the types found and the values that are there."""
    from .sources import files
    path = _scratch(spark, "plain-csv")
    td.raw_incidents(spark, sf_dir).select(*_INFERRED).write.option("header", True).csv(path)
    return rollups.table_summary(files.read_csv_inferred(spark, path))


@register("label_map_round_trip", REGISTRY["label_encode"][1])
def q_label_map_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label map of the neighbourhoods stored and loaded again."""
    path = _scratch(spark, "labels")
    classify.save_label_table(q_label_encode(spark, sf_dir), path)
    return classify.load_label_table(spark, path)


@register("single_file", _INC + """
SELECT year, count(*) AS count, 1 AS files FROM incidents GROUP BY year
""")
def q_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents per year in one CSV file, read back with the number of files they came from."""
    from .sources import files
    path = _scratch(spark, "one-file")
    files.write_csv(rollups.count_by(td.incidents(spark, sf_dir), ["year"]), path, single_file=True)
    back = spark.read.schema("year int, count bigint").option("header", True).options(**files.LOSSLESS).csv(path)
    n_files = back.select(F.input_file_name().alias("f")).distinct().count()
    return back.withColumn("files", F.lit(n_files))


@register("unpredicted_by_hour", _INC + """
, c AS (SELECT hour, type, count(*) AS n FROM incidents GROUP BY hour, type)
, top AS (SELECT hour, type FROM c QUALIFY row_number() OVER (PARTITION BY hour ORDER BY n DESC, type) = 1)
SELECT DISTINCT type AS label FROM incidents WHERE type NOT IN (SELECT type FROM top)
""")
def q_unpredicted_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories that the most frequent category of an hour never is."""
    inc = td.incidents(spark, sf_dir).select("hour", "type")
    guess = topk.top_k(rollups.count_by(inc, ["hour", "type"]), ["hour"], [F.desc("count"), F.asc("type")]).select(
        "hour", F.col("type").alias("predicted"))
    return metrics.unpredicted_classes(inc.join(dims.broadcast_checked(guess), "hour"), "type", "predicted")
