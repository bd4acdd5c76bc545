"""Holiday effects: incidents on public holidays.

Plan: the incident table is scanned once and reduced to daily counts
``(year, month, day, n)`` with a partial aggregate (at most 366 rows a
year, whatever the volume, and a date holding a third of all rows is
pre-aggregated in every map task).  Only those daily counts meet the
calendar.  It comes from a tab-separated file (:func:`read_calendar`) or from
the provincial statutory-holiday rules (:func:`statutory_calendar`), evaluated
by Spark for the years of the daily counts, whichever they are; the daily counts
are then written once to the checkpoint folder, because the calendar and the
join both read them.  Ranking and the per-year breakdown run on the joined daily
rows; the top-k holidays never go to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import parse_us_date
from ..session import cut_lineage
from .dims import broadcast_checked

# Holiday names as the calendar spells them, with their rules.
#   New Year's Day - January 1
#   Family Day - second Monday of February (third Monday from 2019 on)
#   Good Friday - two days before Easter Sunday (Gregorian computus)
#   Victoria Day - the Monday before May 25
#   Canada Day - July 1
#   Civic Holiday - first Monday of August
#   Labour Day - first Monday of September
#   National Day for Truth and Reconciliation - September 30
#   Thanksgiving - second Monday of October
#   Remembrance Day - November 11
#   Christmas Day - December 25
# One-off days (e.g. 2022-09-19 State Funeral of Queen Elizabeth II,
# 2018-06-21 National Aboriginal Day) are passed in as ``extra`` rows.
FAMILY_DAY_THIRD_MONDAY_FROM = 2019

def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated calendar file without header: ``month abbreviation,
    MM/dd/yyyy date, holiday name, ...``.  Lines may carry 4-6 fields and
    CRLF or LF endings; fields after the third are ignored.
    -> ``(date date, holiday string)``."""
    schema = "mon string, date_text string, holiday string"
    raw = spark.read.schema(schema).option("sep", "\t").option("header", False).option("mode", "PERMISSIVE").csv(path)
    return raw.select(parse_us_date(F.col("date_text")).alias("date"),
                      F.regexp_replace(F.col("holiday"), "\r$", "").alias("holiday")).filter(F.col("date").isNotNull())


def _first_weekday(year: Column, month: int, dow: int) -> Column:
    """First day of ``month`` with Spark ``dayofweek`` = ``dow`` (1 = Sunday)."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(first, (F.lit(dow) - F.dayofweek(first) + 7) % 7)


def _nth_monday(year: Column, month: int, n: int | Column) -> Column:
    return F.date_add(_first_weekday(year, month, 2), (F.lit(n) if isinstance(n, int) else n) * 7 - 7)


def _with_easter(ys: DataFrame) -> DataFrame:
    """Add ``_easter`` (Gregorian Easter Sunday of ``year``; anonymous
    algorithm in integer arithmetic).  Intermediate terms are columns of
    their own, computed once per row."""
    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")
    y = F.col("year")
    ys = ys.withColumns({"_a": y % 19, "_b": div(y, 100), "_c": y % 100})
    b, c = F.col("_b"), F.col("_c")
    ys = ys.withColumn("_h", (F.col("_a") * 19 + b - div(b, 4) - div(b - div(b + 8, 25) + 1, 3) + 15) % 30)
    ys = ys.withColumn("_l", ((b % 4) * 2 + div(c, 4) * 2 - F.col("_h") - c % 4 + 32) % 7)
    ys = ys.withColumn("_m", div(F.col("_a") + F.col("_h") * 11 + F.col("_l") * 22, 451))
    ys = ys.withColumn("_t", F.col("_h") + F.col("_l") - F.col("_m") * 7 + 114)
    return ys.withColumn("_easter", F.make_date(y, div(F.col("_t"), 31), F.col("_t") % 31 + 1))


def _holiday_dates(y: Column, easter: Column) -> list[tuple[str, Column]]:
    family_n = F.when(y >= FAMILY_DAY_THIRD_MONDAY_FROM, F.lit(3)).otherwise(F.lit(2))
    may24 = F.make_date(y, F.lit(5), F.lit(24))
    return [
        ("New Year's Day", F.make_date(y, F.lit(1), F.lit(1))),
        ("Family Day", _nth_monday(y, 2, family_n)),
        ("Good Friday", F.date_sub(easter, 2)),
        ("Victoria Day", F.date_sub(may24, (F.dayofweek(may24) + 5) % 7)),
        ("Canada Day", F.make_date(y, F.lit(7), F.lit(1))),
        ("Civic Holiday", _nth_monday(y, 8, 1)),
        ("Labour Day", _nth_monday(y, 9, 1)),
        ("National Day for Truth and Reconciliation", F.make_date(y, F.lit(9), F.lit(30))),
        ("Thanksgiving", _nth_monday(y, 10, 2)),
        ("Remembrance Day", F.make_date(y, F.lit(11), F.lit(11))),
        ("Christmas Day", F.make_date(y, F.lit(12), F.lit(25))),
    ]


def statutory_calendar(years: DataFrame, extra: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Holiday calendar for the distinct ``year`` values of ``years`` (any
    frame with an int ``year`` column), plus ``extra`` ``(yyyy-MM-dd,
    name)`` one-off days.  -> ``(date, holiday)``: one column per holiday,
    then ``unpivot`` to rows."""
    ys = years.select(F.col("year").cast("int").alias("year")).filter(F.col("year").isNotNull()).distinct()
    ys = _with_easter(ys)
    rules = _holiday_dates(F.col("year"), F.col("_easter"))
    wide = ys.select("year", *[d.alias(name) for name, d in rules])
    cal = wide.unpivot("year", [name for name, _ in rules], "holiday", "date").select("date", "holiday")
    if extra:
        spark = years.sparkSession
        more = spark.createDataFrame([(d, n) for d, n in extra], "d string, holiday string").select(
            F.to_date("d").alias("date"), "holiday")
        cal = cal.unionByName(more)
    return cal


def daily_counts(incidents: DataFrame) -> DataFrame:
    """``(year, month, day, n)`` incidents per calendar day."""
    return incidents.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


def _calendar_keys(calendar: DataFrame) -> DataFrame:
    return calendar.select(F.year("date").alias("year"), F.month("date").alias("month"),
                           F.dayofmonth("date").alias("day"), "holiday")


def _daily_and_calendar(incidents: DataFrame, calendar: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Daily counts and the calendar: the caller's, or the rules for the years that occur."""
    daily = daily_counts(incidents)
    if calendar is not None:
        return daily, calendar
    daily = cut_lineage(daily)
    return daily, statutory_calendar(daily)


def holiday_daily(incidents: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Daily incident counts on holidays: ``(year, month, day, holiday, n)``.

    The calendar (the statutory rules for the years of the data when
    ``None``) is joined to the daily counts on the date, inner; a date listed
    under two names counts for both, as in an equi-join of the raw rows."""
    daily, calendar = _daily_and_calendar(incidents, calendar)
    return daily.join(broadcast_checked(_calendar_keys(calendar)), ["year", "month", "day"])


def holiday_ranking(incidents: DataFrame, calendar: DataFrame | None = None, k: int = 3,
                    since_year: int | None = None) -> DataFrame:
    """The ``k`` holidays with the most incidents (optionally only from
    ``since_year`` on): ``(holiday, count bigint)``, ties -> name order."""
    inc = incidents if since_year is None else incidents.filter(F.col("year") >= since_year)
    per = holiday_daily(inc, calendar).groupBy("holiday").agg(F.sum("n").cast("bigint").alias("count"))
    return per.orderBy(F.desc("count"), F.asc("holiday")).limit(k)


def holiday_top_by_year(incidents: DataFrame, calendar: DataFrame | None = None, k: int = 3) -> DataFrame:
    """For the ``k`` holidays with the most incidents over all years, the
    incidents on each of them per year: ``(year, count bigint, holiday)``.
    Fewer than ``k`` holidays with incidents simply give fewer series.

    The ranking is an ordered limit over the per-holiday totals, so no task
    needs all holidays; its ``k`` names are joined back."""
    per_year = cut_lineage(holiday_daily(incidents, calendar).groupBy("holiday", "year")
                           .agg(F.sum("n").cast("bigint").alias("count")))
    top = (per_year.groupBy("holiday").agg(F.sum("count").alias("_total"))
           .orderBy(F.desc("_total"), F.asc("holiday")).limit(k).select("holiday"))
    return per_year.join(F.broadcast(top), "holiday").select("year", "count", "holiday")  # k rows


def holiday_share(incidents: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """One row: ``incidents, on_holidays, share`` (share of incidents that
    fall on a holiday; each date counts once)."""
    daily, calendar = _daily_and_calendar(incidents, calendar)
    dates = _calendar_keys(calendar).select("year", "month", "day").distinct().withColumn("is_holiday", F.lit(1))
    d = daily.join(broadcast_checked(dates), ["year", "month", "day"], "left")
    return d.agg(
        F.sum("n").cast("bigint").alias("incidents"),
        F.coalesce(F.sum(F.when(F.col("is_holiday") == 1, F.col("n"))), F.lit(0)).cast("bigint").alias("on_holidays"),
    ).withColumn("share", F.col("on_holidays") / F.col("incidents"))


HOLIDAY_DISPLAY = {"year": "Year", "count": "Count Of Crimes On Holidays", "holiday": "Holiday"}
