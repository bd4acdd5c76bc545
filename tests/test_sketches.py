"""Stored sketches, heavy hitters and split planning against full counts."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.operators import rollups, sketches
from blotter.sources import jdbc


def _frame(spark, seed=1, n=4000):
    rng = np.random.default_rng(seed)
    values = (rng.zipf(1.3, n) % 700).tolist()
    rows = [(2018 + i % 4, f"v{v}" if v % 11 else None, int(rng.integers(0, 3000)), None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "year int, block string, number int, nothing string").repartition(5)


def test_sketches_by_year_merge_and_grow(spark, tmp_path):
    df, path = _frame(spark), str(tmp_path / "s")
    cols = ["block", "number", "nothing"]
    sketches.save_sketches(df.filter("year < 2021"), cols, path)

    def listed(year):
        return sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / "s" / f"year={year}").iterdir())

    before = listed(2019)
    sketches.save_sketches(df.filter("year = 2021"), cols, path)
    sketches.save_sketches(df.filter("year = 2021"), cols, path)  # the same year again replaces it
    assert listed(2019) == before
    for first, last in ((None, None), (2019, 2020), (2021, None)):
        part = df.filter(F.col("year").between(first or 0, last or 9999))
        got = {r["column_name"]: r for r in sketches.distinct_estimates(sketches.stored_sketches(spark, path), (first, last)).collect()}
        assert set(got) == {"block", "number"}
        for c in got:
            exact = part.select(c).dropna().distinct().count()
            assert got[c]["low"] <= exact <= got[c]["high"] and got[c]["non_null"] == part.filter(F.col(c).isNotNull()).count()
            assert abs(got[c]["estimate"] - exact) <= 3 * sketches.relative_error() * exact + 1


@pytest.mark.parametrize("k, buckets, hashes, spare", [(10, 1 << 16, 2, 4), (10, 16, 2, 1), (5, 4, 1, 1), (1, 64, 3, 1), (5000, 256, 2, 4), (40, 512, 2, 2)])
def test_top_values_equal_the_full_ranking(spark, k, buckets, hashes, spare):
    df = _frame(spark, seed=k)
    want = [tuple(r) for r in rollups.value_counts(df, "block").limit(k).collect()]
    got = [tuple(r) for r in sketches.top_values(df, "block", k, buckets=buckets, hashes=hashes, spare=spare).collect()]
    assert got == want


def test_top_values_of_ties_and_of_nothing(spark):
    df = spark.createDataFrame([(f"v{i:03}",) for i in range(300)] * 2, "v string")
    assert [r["value"] for r in sketches.top_values(df, "v", 7, buckets=32).collect()] == [f"v{i:03}" for i in range(7)]
    assert sketches.top_values(df.filter("1 = 0"), "v", 7).collect() == []


def test_top_values_shuffle_candidates_only(spark):
    df = _frame(spark).cache()
    counts = sketches.bucket_counts(df, "block")
    heavy = counts.filter("hash = 0").orderBy(F.desc("n")).limit(40).agg(F.min("n")).first()[0]
    left = sketches._candidates(df, "block", counts, heavy, sketches.BUCKETS, sketches.HASHES)
    assert left.select("block").distinct().count() <= 45 < df.select("block").distinct().count()


def test_bucket_tables_merge(spark):
    df = _frame(spark)
    parts = [sketches.bucket_counts(df.filter(F.col("year") == y), "block", 64) for y in range(2018, 2022)]
    assert sorted(map(tuple, sketches.merged_counts(parts).collect())) == sorted(map(tuple, sketches.bucket_counts(df, "block", 64).collect()))


@pytest.mark.parametrize("column", ["number", "day", "real", "flat"])
def test_split_predicates_are_disjoint_and_cover(spark, column):
    rng = np.random.default_rng(2)
    rows = [(int(rng.zipf(1.5) % 100000), dt.date(2000, 1, 1) + dt.timedelta(days=int(rng.integers(0, 900))), float(rng.normal()), 7)
            for _ in range(3000)] + [(None, None, None, None)] * 20
    df = spark.createDataFrame(rows, "number int, day date, real double, flat int")
    found = jdbc.quantile_predicates(df, column, 8)
    parts = [df.filter(p).count() for p in found]
    assert sum(parts) == 3020 and 1 <= len(found) <= 8
    hits = [F.when(F.expr(p), 1).otherwise(0) for p in found]
    assert df.select(sum(hits[1:], hits[0]).alias("n")).filter("n <> 1").count() == 0
    assert df.filter(F.col(column).isNull() & F.expr(found[0])).count() == 20
    if column in ("day", "real"):
        assert max(parts) < 2 * 3020 / 8


def test_split_of_an_empty_or_unsupported_key(spark):
    df = spark.createDataFrame([], "number int")
    assert jdbc.quantile_predicates(df, "number", 4) == ["1 = 1"]
    assert jdbc.quantile_predicates(spark.range(10), "id", 1) == ["1 = 1"]
    with pytest.raises(TypeError):
        jdbc.split_predicates("name", ["a'b"])
    with pytest.raises(ValueError):
        jdbc.read_table(spark, "jdbc:x", "t", {}, partition_column="a", predicates=["1 = 1"])
