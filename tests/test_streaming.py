import uuid

import pytest
from pyspark.sql import functions as F

from blotter.operators import hotspots, rollups
from blotter.operators.cleaning import clean_incidents
from blotter.sources import files, tables
from blotter.sources import testdata as td
from blotter.streaming.cleaning import ROCKSDB, clean_stream
from blotter.streaming.rollups import merge_rollup, rollup_merge_stream, rollup_stream, stored_rollup
from tests.conftest import SF_SMALL


def test_rollup_stream_matches_batch(spark, tmp_path):
    inc = td.incidents(spark, SF_SMALL).withColumn("x_neighbourhood", F.col("x_neighbourhood").cast("double"))
    src = tmp_path / "in"
    inc.filter("year < 1998").write.parquet(str(src / "part1"))
    inc.filter("year >= 1998").write.parquet(str(src / "part2"))
    out = str(tmp_path / "out")

    def write(df, batch_id):
        df.write.mode("overwrite").parquet(out)

    q = rollup_stream(spark, str(src / "*"), write, checkpoint_location=str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    want = rollups.rollup_base(inc)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def _clean(spark, raw, points):
    return sorted([tuple(r) for r in clean_incidents(raw, points).collect()], key=str)


def _stored(spark, path):
    return sorted([tuple(r) for r in files.read_clean_incidents(spark, path).collect()], key=str)


@pytest.mark.parametrize("on_disk_state", [True, False])
def test_clean_stream_in_three_drops(spark, tmp_path, on_disk_state):
    raw = td.raw_incidents(spark, SF_SMALL).cache()
    points = td.point_dim(spark, SF_SMALL)
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))

    def run():
        clean_stream(spark, f"{src}/*", out, ckpt, points, fmt="parquet", on_disk_state=on_disk_state).awaitTermination(300)

    files.write_parquet(raw.filter("month <= 6"), f"{src}/1")
    run()
    assert _stored(spark, out) == _clean(spark, raw.filter("month <= 6"), points)
    files.write_parquet(raw.filter("month between 4 and 9"), f"{src}/2")  # half of it was read before
    run()
    assert _stored(spark, out) == _clean(spark, raw.filter("month <= 9"), points)
    files.write_parquet(raw, f"{src}/3")
    run()
    assert _stored(spark, out) == _clean(spark, raw, points)
    run()  # nothing new
    assert _stored(spark, out) == _clean(spark, raw, points)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != ROCKSDB


def _rollup(df):
    return sorted(map(tuple, rollups.rollup_base(df).collect()), key=str)


def test_merge_stream_touches_the_years_of_a_batch_only(spark, tmp_path):
    inc = td.incidents(spark, SF_SMALL).cache()
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))

    def run():
        rollup_merge_stream(spark, f"{src}/*", out, ckpt, available_now=True).awaitTermination(300)
        return sorted(map(tuple, stored_rollup(spark, out).collect()), key=str)

    def listed(year):
        return sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / "out" / f"year={year}").iterdir())

    files.write_parquet(inc.filter("year < 1998 and day < 20"), f"{src}/1")
    assert run() == _rollup(inc.filter("year < 1998 and day < 20"))
    before, other = listed(1996), listed(1997)
    files.write_parquet(inc.filter("(year = 1997 and day >= 20) or year >= 1998"), f"{src}/2")
    assert run() == _rollup(inc.filter("year < 1998 and day < 20 or year = 1997 or year >= 1998"))
    assert listed(1996) == before and listed(1997) != other
    files.write_parquet(inc.filter("year < 1997 and day >= 20").withColumn("year", F.lit(None).cast("int")), f"{src}/3")
    late = inc.filter("year < 1997 and day >= 20").withColumn("year", F.lit(None).cast("int"))
    assert run() == _rollup(inc.filter("year < 1998 and day < 20 or year = 1997 or year >= 1998").unionByName(late))
    assert run() == _rollup(inc.filter("year < 1998 and day < 20 or year = 1997 or year >= 1998").unionByName(late))


def test_merge_of_a_batch_again_counts_once(spark, tmp_path):
    inc = td.incidents(spark, SF_SMALL).cache()
    out = str(tmp_path / "out")
    merge_rollup(inc.filter("year = 1996"), out, 0)
    # A batch that failed after one of its two years had been replaced.
    merge_rollup(inc.filter("year = 1996 and day < 9"), out, 1)
    merge_rollup(inc.filter("year = 1996 and day < 9 or year = 1997"), out, 1)
    want = inc.filter("year in (1996, 1997)").unionByName(inc.filter("year = 1996 and day < 9"))
    assert sorted(map(tuple, stored_rollup(spark, out).collect()), key=str) == _rollup(want)
    merge_rollup(inc.filter("1 = 0"), out, 2)
    assert sorted(map(tuple, stored_rollup(spark, out).collect()), key=str) == _rollup(want)


def test_bucketed_table_needs_no_exchange_of_its_rows(spark, tmp_path):
    inc = td.incidents(spark, SF_SMALL)
    name = f"bucketed_{uuid.uuid4().hex}"
    tables.save_bucketed(inc, name, 8, path=str(tmp_path / "t"))
    try:
        table = tables.read_table(spark, name)
        assert sorted(map(str, table.collect())) == sorted(map(str, inc.collect()))
        districts = td.district_dim(spark, SF_SMALL)
        best = hotspots.district_year_hot_blocks(table, districts, after_year=1997, bounded_dim=True)
        plan = best._jdf.queryExecution().executedPlan().toString()
        # The only shuffle is that of the ranking, above the finished counts.
        ranked = plan.index("Exchange hashpartitioning(district")
        assert plan.count("Exchange hashpartitioning") == 1 and ranked < plan.index("HashAggregate")
        plain = hotspots.district_year_hot_blocks(inc, districts, after_year=1997)
        assert sorted(map(str, best.collect())) == sorted(map(str, plain.collect()))
        counted = table.groupBy("hundred_block").count()
        both = table.join(counted, "hundred_block").groupBy("hundred_block").agg(F.max("count"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    finally:
        spark.sql(f"DROP TABLE {name}")
