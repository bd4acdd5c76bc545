"""Incremental refresh of the rollup tables (the dashboard's periodic
redraw, re-aimed): new clean-incident files dropped into a directory are
folded into the base rollup ``(year, month, hour, type, neighbourhood,
count)``.

:func:`rollup_stream` keeps the table as the state of a Structured Streaming
aggregation, and each micro-batch hands the refreshed table to a
caller-supplied writer.  :func:`rollup_merge_stream` keeps it as a stored
table partitioned by year: a micro-batch's counts are added to the years it
touches, and no other year is read or written.

The state is one row per key of the base grain - bounded by the dimension
cardinalities, not by the number of incidents - so complete output mode is
safe.  Offsets and state live in the checkpoint location, which the caller
names (in shared storage): a query started again with the same location resumes
without recounting.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.rollups import rollup_base
from ..session import cut_lineage
from ..sources.files import CLEAN_SCHEMA

BASE_KEYS = ["year", "month", "hour", "type", "neighbourhood"]
STORED = "month int, hour int, type string, neighbourhood string, count bigint, batch bigint, year int"


def rollup_stream(spark: SparkSession, source_dir: str, write: Callable[[DataFrame, int], None],
                  checkpoint_location: str, fmt: str = "parquet", available_now: bool = False, interval: str | None = "1 hour") -> StreamingQuery:
    """Start the refresh; ``write(table, batch_id)`` receives the whole base
    rollup after every micro-batch (derive the five tables from it with
    :func:`blotter.operators.rollups.rollups`)."""
    agg = rollup_base(_source(spark, source_dir, fmt))
    writer = (agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint_location)
              .foreachBatch(write))
    return _start(writer, available_now, interval)


def _source(spark: SparkSession, source_dir: str, fmt: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(CLEAN_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("header", True).csv(source_dir) if fmt == "csv" else reader.parquet(source_dir)


def _start(writer, available_now: bool, interval: str | None) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def stored_rollup(spark: SparkSession, table_dir: str) -> DataFrame:
    """The stored base rollup ``(year, month, hour, type, neighbourhood, count)``."""
    return spark.read.schema(STORED).parquet(table_dir).select(*BASE_KEYS, "count")


def merge_rollup(incidents: DataFrame, table_dir: str, batch_id: int) -> None:
    """Add the counts of a batch of clean incidents to the stored base rollup, in place.

    Only the partitions of the years in the batch are read and overwritten.  Every stored row carries the number of the batch
    that wrote its year last; a year that already has this batch (or a later one) is left as it is, so a batch that is run
    again after a failure, at whatever point it failed, is not counted twice.  Batch numbers must rise."""
    spark = incidents.sparkSession
    delta = cut_lineage(rollup_base(incidents))  # the batch is read once
    years = [r["year"] for r in delta.select("year").distinct().collect()]  # calendar years of one batch
    if not years:
        return
    spark.createDataFrame([], STORED).write.mode("append").partitionBy("year").parquet(table_dir)  # creates the folder
    named = [y for y in years if y is not None]
    touched = F.col("year").isin(named) | (F.col("year").isNull() if None in years else F.lit(False))
    stored = spark.read.schema(STORED).parquet(table_dir).filter(touched)
    done = stored.groupBy("year").agg(F.max("batch").alias("last")).filter(F.col("last") >= batch_id).select(F.col("year").alias("_done"))
    fresh = delta.join(F.broadcast(done), F.col("year").eqNullSafe(F.col("_done")), "left_anti")  # at most one row a year
    again = stored.join(F.broadcast(done), F.col("year").eqNullSafe(F.col("_done")), "left_anti")
    merged = (again.select(*BASE_KEYS, "count").unionByName(fresh).groupBy(*BASE_KEYS).agg(F.sum("count").alias("count"))
              .withColumn("batch", F.lit(batch_id).cast("bigint")))
    merged = cut_lineage(merged.repartition("year"))  # read in full before its partitions are replaced
    (merged.select("month", "hour", "type", "neighbourhood", "count", "batch", "year").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(table_dir))


def rollup_merge_stream(spark: SparkSession, source_dir: str, table_dir: str, checkpoint_location: str, fmt: str = "parquet",
                        available_now: bool = False, interval: str | None = "1 hour", files_per_batch: int | None = None) -> StreamingQuery:
    """Start the refresh of the stored base rollup in ``table_dir``: every micro-batch goes through :func:`merge_rollup`, so
    its cost follows the batch and the years it touches, not the table."""
    source = _source(spark, source_dir, fmt, files_per_batch)
    writer = source.writeStream.option("checkpointLocation", checkpoint_location).foreachBatch(
        lambda batch, batch_id: merge_rollup(batch, table_dir, batch_id))
    return _start(writer, available_now, interval)
