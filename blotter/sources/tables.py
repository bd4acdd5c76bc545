"""The clean incident table in the catalog, bucketed for the jobs that group by block.

Rows are dealt into buckets by ``hundred_block`` (the finest key of the hot-spot jobs) once, when the table is written.
Aggregates whose keys include the block - per (district, year, block), per (district, neighbourhood, block, year) - and joins on the
block then run inside the buckets: no row of the fact table is shuffled again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKET_BY = "hundred_block"


def save_bucketed(df: DataFrame, name: str, buckets: int, path: str | None = None, by: Sequence[str] = (BUCKET_BY,),
                  partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Save ``df`` as the catalog table ``name`` (parquet), dealt into ``buckets`` by ``by`` and sorted by it in each file.

    Rows are first shuffled by the bucket key, so that a bucket is one file and not one per writing task.  ``path`` puts the
    files of the table there (else: the warehouse); ``partition_by`` adds partition folders, e.g. by year."""
    dealt = df.repartition(buckets, *by)
    writer = dealt.write.mode(mode).format("parquet").bucketBy(buckets, *by).sortBy(*by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str, order_by: Sequence[str] = ()) -> DataFrame:
    """A catalog table by name, ordered if asked (the form in which result tables are read for display)."""
    table = spark.read.table(name)
    return table.orderBy(*order_by) if order_by else table


def save_result(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> None:
    """Save a result table under ``name``."""
    writer = df.write.mode(mode).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
