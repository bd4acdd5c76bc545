"""Stand-in inputs built from the supplied test tables.

These adapters only shape rows into the schemas the jobs expect (the clean
incident table, the raw CSV layout, dimension tables).  They do none of a
job's work; every operator runs on their output exactly as it would on
real data.  Each adapter has a DuckDB twin (``*_SQL``) that the oracle
queries use as a CTE, so both sides start from identical rows.

Mapping (one row per order): ``id`` = order key, ``type`` = lower-cased
order priority, ``timestamp`` = order date, ``neighbourhood`` = lower-cased
nation name of the customer, ``hundred_block`` = lower-cased market segment
plus customer key modulo 20, incident position and neighbourhood point from
keys with some zeros so that the coordinate filters have work to do.
District dimension: nation -> region key for all nations; some incidents
carry a neighbourhood that is not in it.

Key arithmetic (``key % n``) only decides which rows carry a variation
(a zero coordinate, a null, an extra duplicate copy); no adapter drops rows
of the source tables, so every job runs over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean-incident-shaped table (14 columns, FIXTURES.md §2)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    ts = F.col("o_orderdate")
    nk = F.col("n_nationkey")
    ok = F.col("o_orderkey")
    return j.select(
        ok.cast("string").alias("id"),
        F.lower("o_orderpriority").alias("type"),
        ts.alias("timestamp"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
        F.minute(ts).alias("minute"),
        F.when(ok % 83 == 0, F.lit("unlisted")).otherwise(F.lower("n_name")).alias("neighbourhood"),
        F.when(nk == 22, F.lit(0.0)).otherwise((F.lit(49200) + nk * 4) / F.lit(1000.0)).alias("x_neighbourhood"),
        F.when(nk == 22, F.lit(0.0)).otherwise((F.lit(-123200) + nk * 3) / F.lit(1000.0)).alias("y_neighbourhood"),
        F.concat_ws(" ", F.lower("c_mktsegment"), (F.col("c_custkey") % 20).cast("string")).alias("hundred_block"),
        F.when(ok % 97 == 0, F.lit(0.0)).otherwise((F.lit(49200000) + ok % 100000) / F.lit(1000000.0)).alias("x"),
        F.when(ok % 89 == 0, F.lit(0.0)).otherwise((F.lit(-123200000) + F.col("o_custkey") % 100000) / F.lit(1000000.0)).alias("y"),
    )


def district_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(neighbourhood, district)`` from ``nation``."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.lower("n_name").alias("neighbourhood"), F.col("n_regionkey").cast("int").alias("district"))


def far_year_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`incidents` with some of them in the years 1899 and 2101."""
    k = F.col("id").cast("bigint")
    return incidents(spark, sf_dir).withColumn(
        "year", F.when(k % 50 == 0, F.lit(1899)).when(k % 50 == 1, F.lit(2101)).otherwise(F.col("year")))


def hourly_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as incidents with a real time of day: ``type`` = event type."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("type"),
        F.col("ts").alias("timestamp"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.hour("ts").alias("hour"),
        F.minute("ts").alias("minute"),
    )


# DuckDB twins of the adapters above (used inside oracle SQL as CTEs).
INCIDENTS_SQL = """
incidents AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS id,
         lower(o.o_orderpriority) AS type,
         o.o_orderdate AS "timestamp",
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(month(o.o_orderdate) AS INTEGER) AS month,
         CAST(day(o.o_orderdate) AS INTEGER) AS day,
         CAST(hour(o.o_orderdate) AS INTEGER) AS hour,
         CAST(minute(o.o_orderdate) AS INTEGER) AS minute,
         CASE WHEN o.o_orderkey % 83 = 0 THEN 'unlisted' ELSE lower(n.n_name) END AS neighbourhood,
         CASE WHEN n.n_nationkey = 22 THEN 0.0 ELSE (49200 + n.n_nationkey * 4) / 1000.0 END AS x_neighbourhood,
         CASE WHEN n.n_nationkey = 22 THEN 0.0 ELSE (-123200 + n.n_nationkey * 3) / 1000.0 END AS y_neighbourhood,
         lower(c.c_mktsegment) || ' ' || CAST(c.c_custkey % 20 AS VARCHAR) AS hundred_block,
         CASE WHEN o.o_orderkey % 97 = 0 THEN 0.0 ELSE (49200000 + o.o_orderkey % 100000) / 1000000.0 END AS x,
         CASE WHEN o.o_orderkey % 89 = 0 THEN 0.0 ELSE (-123200000 + o.o_custkey % 100000) / 1000000.0 END AS y
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

FAR_YEARS_SQL = INCIDENTS_SQL.replace("incidents AS (", "listed AS (", 1) + """,
incidents AS (
  SELECT * REPLACE (CAST(CASE WHEN CAST(id AS BIGINT) % 50 = 0 THEN 1899 WHEN CAST(id AS BIGINT) % 50 = 1 THEN 2101
                         ELSE year END AS INTEGER) AS year) FROM listed
)"""

DISTRICTS_SQL = """
districts AS (
  SELECT lower(n_name) AS neighbourhood, CAST(n_regionkey AS INTEGER) AS district
  FROM nation
)"""

HOURLY_SQL = """
hourly AS (
  SELECT CAST(event_id AS VARCHAR) AS id, event_type AS type, ts AS "timestamp",
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(minute(ts) AS INTEGER) AS minute
  FROM events
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _raw_block(ok, ck, seg, nat):
    k = ok % 10
    return (
        F.when(k == 0, F.concat((ck % 90 + 1).cast("string"), F.lit("XX "), seg, F.lit(" ST")))
        .when(k == 1, F.concat(F.lit("X "), seg, F.lit(" ST")))
        .when(k == 2, F.concat((ck % 130).cast("string"), F.lit(" AV")))
        .when(k == 3, F.concat(F.lit("W "), F.lpad((ck % 125).cast("string"), 3, "0"), F.lit(" AV")))
        .when(k == 4, F.concat(F.lit("XXXX "), seg, F.lit(" ST")))
        .when(k == 5, F.concat(seg, F.lit(" ST / "), nat, F.lit(" ST")))
        .when(k == 6, F.concat(F.lit('"'), seg, F.lit(' ST" '), nat))
        .when(k == 7, F.lit("XXXX"))
        .when(k == 8, F.concat(F.lit("1XX 2XX "), seg, F.lit(" DR")))
        .otherwise(F.concat(nat, F.lit(" ST")))
    )


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-CSV-shaped rows (FIXTURES.md §1) from orders: upper-case text,
    masked/aliased/quoted block names, UTM metres, some invalid days, null
    neighbourhoods, NaN and zero coordinates, exact duplicates and
    case-only duplicates."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    ok, ck, ts = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    base = j.select(
        ok.alias("k"),
        F.col("o_orderpriority").alias("type"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.when(ok % 101 == 0, F.lit(31)).otherwise(F.dayofmonth(ts)).alias("day"),
        (ok % 24).cast("int").alias("hour"),
        (ck % 60).cast("int").alias("minute"),
        _raw_block(ok, ck, F.col("c_mktsegment"), F.col("n_name")).alias("hundred_block"),
        F.when(ok % 41 == 0, F.lit(None).cast("string")).when(ok % 83 == 0, F.lit("UNLISTED"))
         .otherwise(F.col("n_name")).alias("neighbourhood"),
        F.when(ok % 43 == 0, F.lit(float("nan")))
         .when((ok % 53 == 0) | (ok % 59 == 0), F.lit(0.0))
         .otherwise((F.lit(960000) + ok % 20000) / F.lit(2.0)).alias("x"),
        F.when(ok % 53 == 0, F.lit(0.0)).otherwise((F.lit(10900000) + ck % 20000) / F.lit(2.0)).alias("y"),
    )
    dups = base.filter(F.col("k") % 7 == 0)
    case_dups = base.filter(F.col("k") % 11 == 0).withColumn("type", F.lower("type"))
    return base.unionByName(dups).unionByName(case_dups).drop("k")


def point_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed neighbourhood points ``(neighbourhood, lat, lon)`` (lower-cased
    nation names)."""
    n = table(spark, sf_dir, "nation")
    nk = F.col("n_nationkey")
    return n.select(F.lower("n_name").alias("neighbourhood"),
                    ((F.lit(49200) + nk * 4) / F.lit(1000.0)).alias("lat"),
                    ((F.lit(-123200) + nk * 3) / F.lit(1000.0)).alias("lon"))


def timestamp_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer date/time parts from lineitem keys (some impossible)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.year("l_shipdate").alias("year"),
        ((F.col("l_linenumber") * 5 + F.col("l_partkey")) % 13).cast("int").alias("month"),
        (F.col("l_orderkey") % 31 + 1).cast("int").alias("day"),
        (F.col("l_suppkey") % 25).cast("int").alias("hour"),
        (F.col("l_partkey") % 60).cast("int").alias("minute"),
    )


def utm_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTM zone-10 eastings/northings from supplier keys (some out of range)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    return s.select(
        k,
        F.when(k % 17 == 0, F.lit(50000.0)).otherwise((F.lit(880000) + (k * 7919) % 240000) / F.lit(2.0)).alias("easting"),
        F.when(k % 23 == 0, F.lit(-5.0)).otherwise((F.lit(10860000) + (k * 104729) % 120000) / F.lit(2.0)).alias("northing"),
    )


def _raw_block_sql() -> str:
    seg, nat, ok, ck = "c.c_mktsegment", "n.n_name", "o.o_orderkey", "o.o_custkey"
    return f"""CASE {ok} % 10
      WHEN 0 THEN CAST({ck} % 90 + 1 AS VARCHAR) || 'XX ' || {seg} || ' ST'
      WHEN 1 THEN 'X ' || {seg} || ' ST'
      WHEN 2 THEN CAST({ck} % 130 AS VARCHAR) || ' AV'
      WHEN 3 THEN 'W ' || lpad(CAST({ck} % 125 AS VARCHAR), 3, '0') || ' AV'
      WHEN 4 THEN 'XXXX ' || {seg} || ' ST'
      WHEN 5 THEN {seg} || ' ST / ' || {nat} || ' ST'
      WHEN 6 THEN '"' || {seg} || ' ST" ' || {nat}
      WHEN 7 THEN 'XXXX'
      WHEN 8 THEN '1XX 2XX ' || {seg} || ' DR'
      ELSE {nat} || ' ST' END"""


RAW_SQL = f"""
raw_base AS (
  SELECT o.o_orderkey AS k, o.o_orderpriority AS type,
         CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(month(o.o_orderdate) AS INTEGER) AS month,
         CAST(CASE WHEN o.o_orderkey % 101 = 0 THEN 31 ELSE day(o.o_orderdate) END AS INTEGER) AS day,
         CAST(o.o_orderkey % 24 AS INTEGER) AS hour, CAST(o.o_custkey % 60 AS INTEGER) AS minute,
         {_raw_block_sql()} AS hundred_block,
         CASE WHEN o.o_orderkey % 41 = 0 THEN NULL WHEN o.o_orderkey % 83 = 0 THEN 'UNLISTED'
              ELSE n.n_name END AS neighbourhood,
         CASE WHEN o.o_orderkey % 43 = 0 THEN 'NaN'::DOUBLE
              WHEN o.o_orderkey % 53 = 0 OR o.o_orderkey % 59 = 0 THEN 0.0
              ELSE (960000 + o.o_orderkey % 20000) / 2.0 END AS x,
         CASE WHEN o.o_orderkey % 53 = 0 THEN 0.0 ELSE (10900000 + o.o_custkey % 20000) / 2.0 END AS y
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw AS (
  SELECT type, year, month, day, hour, minute, hundred_block, neighbourhood, x, y FROM raw_base
  UNION ALL SELECT type, year, month, day, hour, minute, hundred_block, neighbourhood, x, y FROM raw_base WHERE k % 7 = 0
  UNION ALL SELECT lower(type), year, month, day, hour, minute, hundred_block, neighbourhood, x, y FROM raw_base WHERE k % 11 = 0
)"""

POINTS_SQL = """
pts AS (
  SELECT lower(n_name) AS neighbourhood, (49200 + n_nationkey * 4) / 1000.0 AS lat,
         (-123200 + n_nationkey * 3) / 1000.0 AS lon
  FROM nation
)"""

TIMESTAMP_PARTS_SQL = """
parts AS (
  SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST((l_linenumber * 5 + l_partkey) % 13 AS INTEGER) AS month,
         CAST(l_orderkey % 31 + 1 AS INTEGER) AS day, CAST(l_suppkey % 25 AS INTEGER) AS hour,
         CAST(l_partkey % 60 AS INTEGER) AS minute
  FROM lineitem
)"""

UTM_POINTS_SQL = """
utm AS (
  SELECT s_suppkey,
         CASE WHEN s_suppkey % 17 = 0 THEN 50000.0 ELSE (880000 + (s_suppkey * 7919) % 240000) / 2.0 END AS easting,
         CASE WHEN s_suppkey % 23 = 0 THEN -5.0 ELSE (10860000 + (s_suppkey * 104729) % 120000) / 2.0 END AS northing
  FROM supplier
)"""
