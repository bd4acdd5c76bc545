"""Stored, mergeable summaries of the incident table.

* Distinct counts: one HyperLogLog sketch per year and column, kept as a binary column of a table partitioned by year.  Any
  range of years is answered by merging their sketches; a new year is one pass over that year and one new partition.
* Heavy hitters: per hash row and bucket, the number of rows whose value falls there (a count-min table, merged by adding).
  A bucket's count is an upper bound for each of its values, which proves when a ranking of the values counted exactly
  is complete.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .dims import broadcast_checked

#: Registers of a distinct-count sketch: 2**14, about 16 KB.
REGISTERS = 14
SKETCHES = "column_name string, sketch binary, non_null bigint, year int"
#: Buckets and hash rows of the heavy-hitter table.
BUCKETS, HASHES = 1 << 16, 2


# ----------------------------------------------------------- distinct counts
def distinct_sketches(df: DataFrame, cols: Sequence[str], by: str = "year", registers: int = REGISTERS) -> DataFrame:
    """``(column_name, sketch, non_null, <by>)``: one sketch per group and column, all from one pass over ``df``.

    Nulls are not counted.  Each task sends one sketch per group and column, whatever the number of rows."""
    made = [F.struct(F.lit(c).alias("column_name"), F.hll_sketch_agg(F.col(c).cast("string"), F.lit(registers)).alias("sketch"),
                     F.count(F.col(c)).alias("non_null")).alias(f"s{i}") for i, c in enumerate(cols)]
    per = df.groupBy(by).agg(*made)
    return per.select(by, F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")).select(
        "s.column_name", "s.sketch", "s.non_null", by)


def save_sketches(df: DataFrame, cols: Sequence[str], path: str, registers: int = REGISTERS) -> None:
    """Sketches of the years in ``df``, stored under ``path``; years stored before stay as they are, a year given again is
    replaced."""
    sketches = distinct_sketches(df, cols, registers=registers)
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCHES).parquet(path)


def distinct_estimates(sketches: DataFrame, years: tuple[int | None, int | None] = (None, None), registers: int = REGISTERS) -> DataFrame:
    """``(column_name, estimate, low, high, non_null)`` over the years ``first .. last`` (inclusive, None: open): the merged
    sketches' estimate and the range of three standard errors around it."""
    first, last = years
    if first is not None:
        sketches = sketches.filter(F.col("year") >= first)
    if last is not None:
        sketches = sketches.filter(F.col("year") <= last)
    merged = sketches.filter("non_null > 0").groupBy("column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"), F.sum("non_null").alias("non_null"))
    room = 3 * relative_error(registers)
    return merged.select("column_name", "estimate", F.floor(F.col("estimate") * (1 - room)).alias("low"),
                         F.ceil(F.col("estimate") * (1 + room)).alias("high"), "non_null")


def relative_error(registers: int = REGISTERS) -> float:
    """Standard error of a merged sketch's estimate, as a share of it."""
    return 1.04 / (1 << registers) ** 0.5


# ------------------------------------------------------------- heavy hitters
def _bucket(value: Column, number: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(number), value), F.lit(buckets)).cast("int")


def bucket_counts(df: DataFrame, col: str, buckets: int = BUCKETS, hashes: int = HASHES) -> DataFrame:
    """``(hash, bucket, n)``: rows per bucket of ``hashes`` independent hashes of ``col``.  Tables of parts of the data (years,
    files) merge with :func:`merged_counts`; a task sends at most ``hashes * buckets`` rows, however many values there are."""
    places = F.array(*[F.struct(F.lit(h).alias("hash"), _bucket(F.col(col), h, buckets).alias("bucket")) for h in range(hashes)])
    return (df.select(F.explode(places).alias("p")).groupBy("p.hash", "p.bucket").agg(F.count(F.lit(1)).alias("n")))


def merged_counts(parts: Sequence[DataFrame]) -> DataFrame:
    """One bucket table of several parts of the data."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("hash", "bucket").agg(F.sum("n").alias("n"))


def _candidates(df: DataFrame, col: str, counts: DataFrame, least: int, buckets: int, hashes: int) -> DataFrame:
    """Rows whose value lies in buckets of at least ``least`` rows under every hash - each value that is that frequent, and a few more."""
    heavy = counts.filter(F.col("n") >= least)
    out = df.select(col)
    for h in range(hashes):
        kept = broadcast_checked(heavy.filter(F.col("hash") == h).select(F.col("bucket").alias("_bucket")))
        out = out.withColumn("_bucket", _bucket(F.col(col), h, buckets)).join(kept, "_bucket", "left_semi").select(col)
    return out


def top_values(df: DataFrame, col: str, k: int, counts: DataFrame | None = None, buckets: int = BUCKETS, hashes: int = HASHES,
               spare: int = 4) -> DataFrame:
    """``(value, count)`` of the ``k`` most frequent values, ties by value: what the full count and sort would give.

    The bucket table (``counts``: a stored one of the same ``buckets`` and ``hashes``, else made here) names the buckets with at
    least as many rows as the ``spare * k``-th fullest one; only values in those are counted, so only they are shuffled.  A value that was left
    out has fewer rows than that; if the k-th candidate has as many, the ranking is complete.  Else the k-th candidate's
    count is the next bound, and every value that could rank lies in a bucket at least that full."""
    counts = cut_lineage(bucket_counts(df, col, buckets, hashes) if counts is None else counts)
    order = [F.desc("count"), F.asc_nulls_first("value")]
    row = counts.filter("hash = 0").orderBy(F.desc("n")).limit(spare * k).agg(F.min("n").alias("n"), F.count("*").alias("m")).first()
    least = int(row["n"]) if row["m"] == spare * k else 1
    while True:
        found = _candidates(df, col, counts, least, buckets, hashes).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
        best = cut_lineage(found.orderBy(*order).limit(k))
        last = best.agg(F.min("count").alias("n"), F.count("*").alias("m")).first()
        if least <= 1 or (last["m"] == k and last["n"] >= least):
            return best.orderBy(*order)
        least = max(1, int(last["n"])) if last["m"] == k else 1
