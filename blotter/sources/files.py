"""File sources and sinks.

Readers always take an explicit schema (schema inference is a full extra
pass over the input and is only offered for exploration); writers never
force a single partition unless asked, because ``repartition(1)`` funnels
the whole table through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Field names and types of the two incident tables.
RAW_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("hundred_block", T.StringType()),
    T.StructField("neighbourhood", T.StringType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])

CLEAN_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("neighbourhood", T.StringType()),
    T.StructField("x_neighbourhood", T.DoubleType()),
    T.StructField("y_neighbourhood", T.DoubleType()),
    T.StructField("hundred_block", T.StringType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])


# Options of the CSV files this library writes and reads back: blanks at
# either end stay, an empty text is not a null, quotes are doubled.  (A text
# that is the null mark itself would come back as null; cells with line breaks
# need ``multiLine`` and cannot be split.)
LOSSLESS = {"nullValue": "\\N", "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "escape": '"'}


def read_raw_incidents(spark: SparkSession, path: str, own: bool = False) -> DataFrame:
    """Raw incident CSV with a header row; cells that do not parse become
    null (permissive mode) and are dropped later by the cleaner.  ``own``: the
    file was written by :func:`write_csv`; in other files an empty cell is
    null."""
    reader = spark.read.schema(RAW_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
    return reader.options(**LOSSLESS).csv(path) if own else reader.csv(path)


def read_clean_incidents(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Clean incident table from parquet (default) or a CSV with header."""
    if fmt == "csv":
        return spark.read.schema(CLEAN_SCHEMA).option("header", True).options(**LOSSLESS).csv(path)
    return spark.read.schema(CLEAN_SCHEMA).parquet(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header and inferred types (exploration only: inference
    reads the input an extra time)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def from_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """Local rows -> DataFrame (small literal inputs such as scoring
    requests or dimension rows)."""
    return spark.createDataFrame(rows, schema)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> None:
    """CSV with header that reads back unchanged with :data:`LOSSLESS`.
    ``single_file`` coalesces to one partition: only for small results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).options(**{**LOSSLESS, "emptyValue": '""'}).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet, optionally partitioned (``year`` gives partition pruning to
    every year-filtered job)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
