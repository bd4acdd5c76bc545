"""The command-line jobs end to end on a small raw CSV."""
import uuid

import pytest
from pyspark.sql import functions as F

from blotter import jobs
from blotter.operators import cleaning, rollups
from blotter.sources import files
from blotter.sources import testdata as td
from blotter.streaming.rollups import stored_rollup
from tests.conftest import SF_SMALL


def test_jobs_end_to_end(spark, tmp_path):
    raw_path = str(tmp_path / "raw")
    files.write_csv(td.raw_incidents(spark, SF_SMALL), raw_path)
    pts = str(tmp_path / "points")
    files.write_csv(td.point_dim(spark, SF_SMALL), pts, single_file=True)
    dd = str(tmp_path / "districts")
    files.write_csv(td.district_dim(spark, SF_SMALL), dd, single_file=True)
    clean = str(tmp_path / "clean")
    jobs.run(["clean", raw_path, clean, "--points", pts, "--partition-by-year"], spark=spark)
    c = files.read_clean_incidents(spark, clean)
    assert c.count() > 0 and c.filter(F.col("x_neighbourhood").isNotNull()).count() > 0

    out = str(tmp_path / "out")
    jobs.run(["rollups", clean, f"{out}/rollups"], spark=spark)
    assert spark.read.parquet(f"{out}/rollups/type").agg(F.sum("count")).first()[0] == c.count()
    jobs.run(["hot-blocks", clean, f"{out}/hot", "--after-year", "1996", "--districts", dd], spark=spark)
    assert spark.read.parquet(f"{out}/hot").count() > 0
    jobs.run(["district-counts", clean, f"{out}/dc", "--years", "1996", "1997", "--districts", dd], spark=spark)
    jobs.run(["least-district", clean, f"{out}/ld", "--years", "1996", "1997", "--districts", dd], spark=spark)
    jobs.run(["district-points", clean, f"{out}/pts", "--district", "1", "--years", "1996", "--districts", dd],
             spark=spark)
    jobs.run(["--format", "csv", "holidays", clean, f"{out}/hol"], spark=spark)
    jobs.run(["--display-names", "holidays", clean, f"{out}/hol_display"], spark=spark)
    assert spark.read.parquet(f"{out}/hol_display/by_year").columns == ["Year", "Count Of Crimes On Holidays", "Holiday"]
    assert spark.read.option("header", True).csv(f"{out}/hol/share").count() == 1
    jobs.run(["train", clean, f"{out}/model", "--targets", "1-urgent", "2-high", "--metrics-out", f"{out}/metrics"],
             spark=spark)
    req = tmp_path / "req.csv"
    req.write_text("request_id,year,month,hour,neighbourhood,hundred_block\nr1,1996,5,3,nation_1,building st\n")
    jobs.run(["score", f"{out}/model", str(req), f"{out}/scored"], spark=spark)
    assert spark.read.parquet(f"{out}/scored").count() == 1
    jobs.run(["knn", clean, f"{out}/knn", "--k", "5"], spark=spark)
    acc = spark.read.parquet(f"{out}/knn/accuracy").first()
    assert 0.0 <= acc.accuracy <= 1.0


def test_clean_without_points_and_existing_output(spark, tmp_path):
    raw = str(tmp_path / "raw")
    files.write_csv(td.raw_incidents(spark, SF_SMALL), raw)
    clean = str(tmp_path / "clean")
    jobs.run(["clean", raw, clean], spark=spark)
    inc = files.read_clean_incidents(spark, clean)
    assert inc.filter(F.col("x_neighbourhood").isNotNull()).count() > 0.9 * inc.count()
    dd = str(tmp_path / "districts")
    files.write_csv(td.district_dim(spark, SF_SMALL), dd, single_file=True)
    jobs.run(["least-district", clean, str(tmp_path / "ld"), "--years", "1996", "1997", "--districts", dd, "--leave-out",
              "nation_1=building st", "--coordinates", "any"], spark=spark)
    assert spark.read.parquet(str(tmp_path / "ld")).count() > 0
    jobs.run(["train", clean, str(tmp_path / "m"), "--exclude", "5-low", "--trees", "3", "--train-percent", "67", "--partitions", "4",
              "--metrics-out", str(tmp_path / "metrics")], spark=spark)
    assert spark.read.option("header", True).csv(str(tmp_path / "metrics/report")).count() == 4
    with pytest.raises(Exception, match="already exists"):
        jobs.run(["clean", raw, clean], spark=spark)
    jobs.run(["clean", raw, clean, "--overwrite"], spark=spark)


def test_jdbc_arguments(spark, monkeypatch):
    with pytest.raises(SystemExit):
        jobs.run(["--format", "jdbc", "rollups", "t", "out"], spark=spark)
    with pytest.raises(SystemExit):
        jobs.run(["--input-format", "jdbc", "rollups", "t", "out"], spark=spark)
    asked = {}

    def read(spark, url, table, props, **more):
        asked.update(url=url, table=table, props=props, **more)
        raise KeyboardInterrupt

    monkeypatch.setattr(jobs.jdbc, "read_table", read)
    with pytest.raises(KeyboardInterrupt):
        jobs.run(["--input-format", "jdbc", "--jdbc-url", "jdbc:x", "--jdbc-prop", "user=me", "--jdbc-split", "year", "2003", "2022", "8",
                  "rollups", "incidents", "out"], spark=spark)
    assert asked == {"url": "jdbc:x", "table": "incidents", "props": {"user": "me"}, "partition_column": "year", "lower_bound": "2003",
                     "upper_bound": "2022", "num_partitions": 8}


def test_incremental_and_table_jobs(spark, tmp_path):
    raw = td.raw_incidents(spark, SF_SMALL).cache()
    pts, drops, clean = str(tmp_path / "points"), str(tmp_path / "drops"), str(tmp_path / "clean")
    files.write_csv(td.point_dim(spark, SF_SMALL), pts, single_file=True)
    base = str(tmp_path / "base")
    for step, part in enumerate(("month <= 6", "month >= 5")):
        files.write_parquet(raw.filter(part), f"{drops}/{step}")
        jobs.run(["clean-new", f"{drops}/*", clean, "--points", pts, "--checkpoint", str(tmp_path / "c1"), "--raw-format", "parquet"], spark=spark)
        jobs.run(["rollup-new", clean, base, "--checkpoint", str(tmp_path / "c2")], spark=spark)
    inc = files.read_clean_incidents(spark, clean)
    want = cleaning.clean_incidents(raw, td.point_dim(spark, SF_SMALL))
    assert inc.count() == want.count() == inc.select("id").distinct().count()
    assert sorted(map(tuple, stored_rollup(spark, base).collect())) == sorted(map(tuple, rollups.rollup_base(want).collect()))
    jobs.run(["top-blocks", clean, str(tmp_path / "top"), "--k", "5"], spark=spark)
    top = spark.read.parquet(str(tmp_path / "top")).orderBy(F.desc("count"), "value").collect()
    assert [tuple(r) for r in top] == [tuple(r) for r in rollups.value_counts(want, "hundred_block").limit(5).collect()]
    name = f"incidents_{uuid.uuid4().hex}"
    jobs.run(["save-table", clean, name, "--buckets", "4", "--path", str(tmp_path / "t")], spark=spark)
    assert spark.read.table(name).count() == inc.count()
    spark.sql(f"DROP TABLE {name}")
    model, req = str(tmp_path / "m"), tmp_path / "req.csv"
    jobs.run(["train", clean, model, "--classifier", "table", "--targets", "1-urgent", "2-high", "--trees", "2", "--depth", "2", "--metrics-out",
              str(tmp_path / "metrics")], spark=spark)
    req.write_text("request_id,year,month,hour,neighbourhood,hundred_block\nr1,1996,5,3,nation_1,no such\n")
    jobs.run(["score", "--classifier", "table", model, str(req), str(tmp_path / "scored")], spark=spark)
    assert spark.read.parquet(str(tmp_path / "scored")).first()["status"] == "unknown_input"
    assert spark.read.option("header", True).csv(str(tmp_path / "metrics" / "metrics")).count() == 1
