"""Physical-plan checks: the plans the operators are designed to produce."""
from pyspark.sql import functions as F

from blotter.operators import dims, holidays, hotspots, rollups
from blotter.sources import files
from blotter.sources import testdata as td
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # run once so AQE shows final plans
    return df._jdf.queryExecution().executedPlan().toString()


def _clean_parquet(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    path = str(tmp_path / "clean")
    files.write_parquet(td.incidents(spark, SF_SMALL), path, partition_by=["year"])
    return files.read_clean_incidents(spark, path)


def test_hot_blocks_plan(spark):
    df = hotspots.district_year_hot_blocks(td.incidents(spark, SF_SMALL), dims.city_district_dim(spark),
                                           bounded_dim=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "WindowGroupLimit" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_year_filter_prunes_partitions_and_columns(spark, tmp_path):
    clean = _clean_parquet(spark, tmp_path)
    df = hotspots.district_points(clean, td.district_dim(spark, SF_SMALL), 2, years=[1998, 1999])
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "clean" in ln][0]
    part = scan[scan.index("PartitionFilters: "):scan.index("PushedFilters: ")]
    assert "year" in part and "1998" in part and "1999" in part
    assert "ReadSchema: struct<neighbourhood:string,x_neighbourhood:double,y_neighbourhood:double,x:double,y:double>" in scan


def test_hot_block_points_push_block_filter(spark, tmp_path):
    clean = _clean_parquet(spark, tmp_path)
    df = hotspots.hot_block_points(clean, td.district_dim(spark, SF_SMALL), 2, ["household 3"], years=[1998])
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "clean" in ln][0]
    pushed = scan[scan.index("PushedFilters: "):]
    assert "EqualTo(hundred_block,household 3)" in pushed or "In(hundred_block" in pushed


def test_grouping_sets_single_scan(spark, tmp_path):
    clean = _clean_parquet(spark, tmp_path)
    plan = _plan(rollups.rollup_grouping_sets(clean))
    assert plan.count("FileScan parquet") == 1
    assert "Expand" in plan


def test_holiday_join_after_daily_aggregate(spark, tmp_path):
    clean = _clean_parquet(spark, tmp_path)
    df = holidays.holiday_daily(clean, holidays.statutory_calendar(spark.range(2020, 2023).select(F.col("id").alias("year"))))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # The join with the calendar sits above the daily aggregate of incidents.
    join_at = plan.find("Join Inner")
    agg_at = plan.find("Aggregate [year#", join_at)
    assert join_at >= 0 and agg_at > join_at


def test_dimension_size_check(spark):
    big = spark.range(50).select(F.col("id").cast("string").alias("neighbourhood"), F.lit(1).alias("district"))
    assert "ResolvedHint" in big.hint("broadcast")._jdf.queryExecution().analyzed().toString()
    hinted = dims.broadcast_checked(big, max_rows=100)
    unhinted = dims.broadcast_checked(big, max_rows=10)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in unhinted._jdf.queryExecution().analyzed().toString().lower()


def test_hot_key_is_pre_aggregated(spark):
    """A block holding a third of all rows: the plan counts it map-side
    (partial aggregate below the shuffle) and the result is exact."""
    n = 300_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot st")).otherwise(F.concat(F.lit("b"), (F.col("id") % 997).cast("string")))
        .alias("hundred_block"),
        F.lit("west end").alias("neighbourhood"),
        F.lit(2021).alias("year"))
    out = hotspots.district_year_hot_blocks(df, dims.city_district_dim(spark), bounded_dim=True)
    assert [tuple(r) for r in out.collect()] == [(2021, "hot st", n // 3, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    partial = plan.find("partial_count")
    exchange = plan.find("Exchange hashpartitioning(district")
    assert 0 <= exchange < partial  # printed top-down: the partial aggregate sits below the exchange


def test_no_udf_cartesian_or_nested_loop_in_any_registered_query(spark):
    from blotter import catalog
    bad = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")
    for key, (fn, _) in catalog.REGISTRY.items():
        df = fn(spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = [b for b in bad if b in plan]
        assert not found, (key, found)
