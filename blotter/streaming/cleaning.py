"""Incremental cleaning: new raw files are cleaned as they arrive and appended to the clean table.

Duplicates are removed across all files ever read: the state holds the id (a hash of the raw record) of every row seen, in the
state store below the checkpoint location, partitioned by id - so it is as large as 64 characters per distinct record and is
kept on disk by the RocksDB store, never in the memory of one task.  The file sink's log in the output folder makes the
append exactly-once: a batch that is run again after a failure replaces what it had written, and a query started again with
the same checkpoint location reads new files only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import identified, shaped
from ..sources.files import RAW_SCHEMA

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def clean_stream(spark: SparkSession, source_dir: str, table_dir: str, checkpoint_location: str, points: DataFrame,
                 fmt: str = "csv", coordinate_filter: str = "loose", zone: int = 10, northern: bool = True,
                 partition_by_year: bool = False, available_now: bool = True, interval: str | None = None,
                 files_per_batch: int | None = None, on_disk_state: bool = True) -> StreamingQuery:
    """Start the job: raw files below ``source_dir`` (``csv`` with a header, or ``parquet``) -> clean rows appended to
    ``table_dir`` (parquet).  The rows are those :func:`blotter.operators.cleaning.clean_incidents` gives for all files
    together, whatever the order and the batches in which they arrive.

    ``points`` is the neighbourhood point table (centroids of rows not seen yet cannot be known).  ``available_now`` processes
    what is there and stops; otherwise the query runs on, every ``interval``.  ``files_per_batch`` bounds a micro-batch;
    ``on_disk_state`` keeps the state in RocksDB (it must be the same at every start with one checkpoint location)."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.option("header", True).csv(source_dir) if fmt == "csv" else reader.parquet(source_dir)
    fresh = identified(raw.dropna(how="any")).dropDuplicates(["id"])
    clean = shaped(fresh, points, coordinate_filter, zone, northern)
    writer = (clean.writeStream.format("parquet").outputMode("append").option("path", table_dir)
              .option("checkpointLocation", checkpoint_location))
    if partition_by_year:
        writer = writer.partitionBy("year")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    if not on_disk_state:
        return writer.start()
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)  # read when the query starts
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
