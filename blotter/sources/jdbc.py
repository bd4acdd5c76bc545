"""JDBC source and sink.

Connection details (URL, user, password, driver) are always supplied by
the caller; nothing is stored here.  Reads are split into parallel range
queries on a numeric or date column, so a large table is not pulled
through one connection and one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
               partition_column: str | None = None, lower_bound: int | str | None = None,
               upper_bound: int | str | None = None, num_partitions: int | None = None,
               fetch_size: int = 10000, predicates: Sequence[str] | None = None) -> DataFrame:
    """Table (or ``(subquery) alias``) over JDBC; with ``partition_column``
    and bounds the read is split into ``num_partitions`` range queries of
    equal width, with ``predicates`` (:func:`quantile_predicates`) into one
    query each."""
    if predicates is not None:
        if partition_column is not None:
            raise ValueError("give predicates or a partition column, not both")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties={**properties, "fetchsize": str(fetch_size)})
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for key, value in properties.items():
        reader = reader.option(key, value)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    return reader.load()


def quantile_bounds(keys: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list:
    """At most ``parts - 1`` rising values of ``column`` that cut the rows of ``keys`` into shares of about equal size.

    ``keys`` is a table with the split column as the database has it: an earlier export, or the key column read alone.  A
    numeric, date or timestamp column; approximate percentiles (error ``1 / accuracy`` of the rows), one partial aggregate.
    A value so frequent that it spans several shares is one bound, so there can be fewer shares."""
    if parts < 2:
        return []
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = keys.agg(F.percentile_approx(F.col(column), shares, F.lit(accuracy)).alias("q")).first()["q"]
    return sorted(set(found or []))


def _sql_literal(value) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, dt.date)):
        raise TypeError(f"cannot split on values like {value!r}")
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    return f"DATE '{value.isoformat()}'" if isinstance(value, dt.date) else repr(value) if isinstance(value, float) else str(value)


def split_predicates(column: str, bounds: Sequence) -> list[str]:
    """One condition per share between ``bounds``: disjoint, together all rows; null keys go with the first."""
    if not bounds:
        return ["1 = 1"]
    marks = [_sql_literal(b) for b in bounds]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(marks, marks[1:])]
    return [f"{column} < {marks[0]} OR {column} IS NULL", *inner, f"{column} >= {marks[-1]}"]


def quantile_predicates(keys: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[str]:
    """Conditions for :func:`read_table` that give its tasks about equally many rows, however the keys are spread."""
    return split_predicates(column, quantile_bounds(keys, column, parts, accuracy))


def write_table(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "overwrite",
                batch_size: int = 1000, num_partitions: int | None = None, truncate: bool = True) -> None:
    """Write over JDBC in batches; ``num_partitions`` caps concurrent
    connections; ``truncate`` keeps the table definition on overwrite."""
    writer = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
              .option("batchsize", batch_size).option("truncate", str(truncate).lower()))
    if num_partitions is not None:
        writer = writer.option("numPartitions", num_partitions)
    for key, value in properties.items():
        writer = writer.option(key, value)
    writer.save()
