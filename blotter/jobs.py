"""Command-line jobs: one sub-command per batch job of the original tool
chain, reading the clean table (parquet, or CSV with ``--input-format
csv``) and writing each result table to parquet, CSV or a JDBC table.

    python -m blotter.jobs clean raw.csv out/clean --points points.csv
    python -m blotter.jobs rollups out/clean out/rollups
    python -m blotter.jobs district-counts out/clean out/district_counts
    python -m blotter.jobs least-district out/clean out/least_district
    python -m blotter.jobs district-points out/clean out/points --district 2
    python -m blotter.jobs hot-block-points out/clean out/hot_points --district 2 \
        --blocks "e hastings st" "nk_loc st" "commercial dr"
    python -m blotter.jobs hot-blocks out/clean out/hot_blocks
    python -m blotter.jobs holidays out/clean out/holidays --calendar holidays.txt
    python -m blotter.jobs train out/clean out/model
    python -m blotter.jobs score out/model requests.csv out/scored
    python -m blotter.jobs knn out/clean out/knn
    python -m blotter.jobs clean-new raw_dir out/clean --points points.csv --checkpoint shared/clean
    python -m blotter.jobs rollup-new clean_dir out/rollup_base --checkpoint shared/rollup
    python -m blotter.jobs top-blocks out/clean out/top --k 20
    python -m blotter.jobs save-table out/clean incidents --buckets 512

On a cluster: ``spark-submit --py-files blotter.zip run_job.py <job> ...``.
JDBC sinks take ``--format jdbc --jdbc-url URL --jdbc-table TABLE`` and
connection properties as ``--jdbc-prop key=value`` (user, password,
driver...), always from the caller.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import cleaning, dims, holidays, hotspots, metrics, rollups, sketches
from .plans import classify, forest, knn
from .session import apply_cluster_conf
from .sources import files, jdbc
from .sources import tables as catalog_tables
from .streaming import cleaning as cleaning_stream
from .streaming import rollups as rollup_stream


def _props(args: argparse.Namespace) -> dict[str, str]:
    return dict(p.split("=", 1) for p in (args.jdbc_prop or []))


def _sink(df: DataFrame, out: str, args: argparse.Namespace, name: str | None = None) -> None:
    if args.format == "jdbc":
        table = args.jdbc_table if name is None else f"{args.jdbc_table}_{name}"
        jdbc.write_table(df, args.jdbc_url, table, _props(args), mode="overwrite", batch_size=args.batch_size)
        return
    path = out if name is None else f"{out.rstrip('/')}/{name}"
    if args.format == "csv":
        files.write_csv(df, path, mode="overwrite")
    else:
        files.write_parquet(df, path)


def _clean(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.input_format == "jdbc":
        bounds = dict(zip(("partition_column", "lower_bound", "upper_bound", "num_partitions"), args.jdbc_split or []))
        if bounds:
            bounds["num_partitions"] = int(bounds["num_partitions"])
        return jdbc.read_table(spark, args.jdbc_url, args.clean, _props(args), **bounds)
    return files.read_clean_incidents(spark, args.clean, fmt=args.input_format)


def _districts(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, bool]:
    if getattr(args, "districts", None):
        dim = spark.read.schema(dims.DISTRICT_SCHEMA).option("header", True).csv(args.districts)
        return dim, False
    return dims.city_district_dim(spark), True


def _points(spark: SparkSession, path: str | None) -> tuple[DataFrame | None, bool]:
    """The point table, or None: centroids of the located incidents."""
    if path is None:
        return None, False
    return spark.read.schema(dims.POINT_SCHEMA).option("header", True).csv(path), False


def run(argv: Sequence[str], spark: SparkSession | None = None) -> None:
    ap = argparse.ArgumentParser(prog="blotter.jobs")
    ap.add_argument("--format", choices=["parquet", "csv", "jdbc"], default="parquet")
    ap.add_argument("--input-format", choices=["parquet", "csv", "jdbc"], default="parquet",
                    help="of the clean table; with jdbc its argument is a table name")
    ap.add_argument("--jdbc-split", nargs=4, metavar=("COLUMN", "LOWER", "UPPER", "PARTS"),
                    help="read over JDBC in ranges of a column")
    ap.add_argument("--conf", action="append", metavar="KEY=VALUE",
                    help="session settings on top of the cluster settings")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-table")
    ap.add_argument("--jdbc-prop", action="append")
    ap.add_argument("--batch-size", type=int, default=1000)
    ap.add_argument("--display-names", action="store_true",
                    help="name result columns as the dashboard shows them (hot blocks, top blocks, holidays)")
    sub = ap.add_subparsers(dest="job", required=True)

    p = sub.add_parser("clean", help="raw CSV -> clean incident table")
    p.add_argument("raw")
    p.add_argument("out")
    p.add_argument("--points", help="CSV neighbourhood,lat,lon (header); default: centroids of the incidents")
    p.add_argument("--overwrite", action="store_true", help="replace an existing output (default: fail)")
    p.add_argument("--strict", action="store_true", help="drop rows with either coordinate 0")
    p.add_argument("--partition-by-year", action="store_true")

    for name in ("rollups", "district-counts", "least-district", "hot-blocks", "knn"):
        p = sub.add_parser(name)
        p.add_argument("clean")
        p.add_argument("out")
        p.add_argument("--districts", help="CSV neighbourhood,district (header); default: the city's map")
    sub.choices["district-counts"].add_argument("--years", type=int, nargs="+", default=list(hotspots.REFERENCE_YEARS))
    sub.choices["least-district"].add_argument("--years", type=int, nargs="+", default=list(hotspots.REFERENCE_YEARS))
    sub.choices["least-district"].add_argument("--leave-out", nargs="*", metavar="NEIGHBOURHOOD=BLOCK",
                                               help="pairs left out; default: the original job's pair; none: leave nothing out")
    sub.choices["least-district"].add_argument("--coordinates", choices=["loose", "strict", "any"], default="loose")
    sub.choices["hot-blocks"].add_argument("--after-year", type=int, default=2019)
    sub.choices["knn"].add_argument("--k", type=int, default=25)
    sub.choices["knn"].add_argument("--train-percent", type=int, default=67)

    for name in ("district-points", "hot-block-points"):
        p = sub.add_parser(name)
        p.add_argument("clean")
        p.add_argument("out")
        p.add_argument("--district", type=int, default=2)
        p.add_argument("--years", type=int, nargs="+", default=list(hotspots.REFERENCE_YEARS))
        p.add_argument("--districts")
        p.add_argument("--blocks", nargs="+", required=name == "hot-block-points")

    p = sub.add_parser("holidays")
    p.add_argument("clean")
    p.add_argument("out")
    p.add_argument("--calendar", help="tab-separated calendar file; default: statutory rules")
    p.add_argument("--k", type=int, default=3)
    p.add_argument("--since-year", type=int, default=2018)

    p = sub.add_parser("train")
    p.add_argument("clean")
    p.add_argument("model")
    p.add_argument("--classifier", choices=["rf", "nb", "table"], default="rf", help="table: a forest grown by group-bys, kept as tables")
    p.add_argument("--depth", type=int, default=5, help="of the table forest")
    p.add_argument("--targets", nargs="+", default=list(classify.REFERENCE_TARGETS))
    p.add_argument("--exclude", nargs="*", help="train on all categories but these instead (default list if empty)")
    p.add_argument("--trees", type=int, default=10)
    p.add_argument("--max-bins", type=int)
    p.add_argument("--train-percent", type=int, default=80)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--smoothing", type=float, default=1.0)
    p.add_argument("--partitions", type=int, default=classify.TRAIN_PARTITIONS)
    p.add_argument("--metrics-out", help="folder for metrics, per-class report and confusion table (CSV)")

    p = sub.add_parser("clean-new", help="clean the raw files that arrived since the last start and append what is new")
    p.add_argument("raw", help="folder of raw files")
    p.add_argument("out")
    p.add_argument("--points", required=True, help="CSV neighbourhood,lat,lon (header)")
    p.add_argument("--checkpoint", required=True, help="folder in shared storage; the same at every start")
    p.add_argument("--strict", action="store_true")
    p.add_argument("--partition-by-year", action="store_true")
    p.add_argument("--raw-format", choices=["csv", "parquet"], default="csv")

    p = sub.add_parser("rollup-new", help="add the clean files that arrived since the last start to the stored base rollup")
    p.add_argument("clean", help="folder of clean files")
    p.add_argument("out")
    p.add_argument("--checkpoint", required=True, help="folder in shared storage; the same at every start")

    p = sub.add_parser("top-blocks", help="the most frequent blocks")
    p.add_argument("clean")
    p.add_argument("out")
    p.add_argument("--k", type=int, default=20)

    p = sub.add_parser("save-table", help="the clean table as a catalog table bucketed by block")
    p.add_argument("clean")
    p.add_argument("name")
    p.add_argument("--buckets", type=int, default=512)
    p.add_argument("--path", help="folder of the table's files; default: the warehouse")

    p = sub.add_parser("score")
    p.add_argument("--classifier", choices=["rf", "nb", "table"], default="rf")
    p.add_argument("model")
    p.add_argument("requests", help="CSV request_id,year,month,hour,neighbourhood,hundred_block (header)")
    p.add_argument("out")

    args = ap.parse_args(list(argv))
    if args.format == "jdbc" and not (args.jdbc_url and args.jdbc_table):
        ap.error("--format jdbc needs --jdbc-url and --jdbc-table")
    if args.input_format == "jdbc" and not args.jdbc_url:
        ap.error("--input-format jdbc needs --jdbc-url")
    own = spark is None
    spark = spark or SparkSession.builder.appName(f"blotter-{args.job}").getOrCreate()
    if own:
        apply_cluster_conf(spark, dict(c.split("=", 1) for c in (args.conf or [])))
    try:
        _dispatch(spark, args)
    finally:
        if own:
            spark.stop()


def _dispatch(spark: SparkSession, args: argparse.Namespace) -> None:
    job = args.job
    if job == "clean":
        points, bounded = _points(spark, args.points)
        clean = cleaning.clean_incidents(files.read_raw_incidents(spark, args.raw), points,
                                         coordinate_filter="strict" if args.strict else "loose",
                                         bounded_points=bounded)
        mode = "overwrite" if args.overwrite else "errorifexists"
        if args.format == "parquet":
            files.write_parquet(clean, args.out, mode=mode, partition_by=["year"] if args.partition_by_year else None)
        elif args.format == "csv":
            files.write_csv(clean, args.out, mode=mode)
        else:
            jdbc.write_table(clean, args.jdbc_url, args.jdbc_table, _props(args), mode=mode, batch_size=args.batch_size)
        return
    if job == "clean-new":
        points, _ = _points(spark, args.points)
        cleaning_stream.clean_stream(spark, args.raw, args.out, args.checkpoint, points, fmt=args.raw_format,
                                     coordinate_filter="strict" if args.strict else "loose",
                                     partition_by_year=args.partition_by_year).awaitTermination()
        return
    if job == "rollup-new":
        rollup_stream.rollup_merge_stream(spark, args.clean, args.out, args.checkpoint, fmt=args.input_format,
                                          available_now=True).awaitTermination()
        return
    if job == "score":
        requests = spark.read.schema("request_id string, year int, month int, hour int, neighbourhood string, "
                                     "hundred_block string").option("header", True).csv(args.requests)
        if args.classifier == "table":
            scored = forest.score_requests(forest.load(spark, args.model), requests)
        else:
            scored = classify.score_requests(classify.load(args.model), requests)
        _sink(scored, args.out, args)
        return

    inc = _clean(spark, args)
    if job == "rollups":
        base = rollups.rollup_base(inc).persist()
        for grain, table in rollups.rollups(inc, base=base).items():
            _sink(table, args.out, args, name=grain)
        base.unpersist()
    elif job == "district-counts":
        dim, bounded = _districts(spark, args)
        _sink(hotspots.district_year_counts(inc, dim, args.years, bounded_dim=bounded), args.out, args)
    elif job == "least-district":
        dim, bounded = _districts(spark, args)
        pairs = (hotspots.REFERENCE_LEFT_OUT if args.leave_out is None
                 else [tuple(p.split("=", 1)) for p in args.leave_out])
        where = None if args.coordinates == "any" else args.coordinates
        out = hotspots.least_district_top_blocks(inc, dim, args.years, exclude=pairs, coordinate_filter=where,
                                                 bounded_dim=bounded)
        _sink(hotspots.display(out, hotspots.TOP_BLOCK_DISPLAY) if args.display_names else out, args.out, args)
    elif job == "hot-blocks":
        dim, bounded = _districts(spark, args)
        out = hotspots.district_year_hot_blocks(inc, dim, args.after_year, bounded_dim=bounded)
        _sink(hotspots.display(out, hotspots.HOT_BLOCK_DISPLAY) if args.display_names else out, args.out, args)
    elif job in ("district-points", "hot-block-points"):
        dim, bounded = _districts(spark, args)
        _sink(hotspots.district_points(inc, dim, args.district, args.years, args.blocks, bounded_dim=bounded),
              args.out, args)
    elif job == "holidays":
        cal = holidays.read_calendar(spark, args.calendar) if args.calendar else None
        by_year = holidays.holiday_top_by_year(inc, cal, k=args.k)
        if args.display_names:
            by_year = hotspots.display(by_year, holidays.HOLIDAY_DISPLAY)
        _sink(by_year, args.out, args, name="by_year")
        _sink(holidays.holiday_ranking(inc, cal, k=args.k, since_year=args.since_year), args.out, args, name="recent")
        _sink(holidays.holiday_share(inc, cal), args.out, args, name="share")
    elif job == "train":
        if args.exclude is None:
            rows = classify.training_rows(inc, include=args.targets)
        else:
            rows = classify.training_rows(inc, include=None, exclude=args.exclude or classify.REFERENCE_EXCLUDED)
        if args.classifier == "table":
            made = forest.train(rows, trees=args.trees, depth=args.depth, train_percent=args.train_percent)
            forest.save(made, args.model)
            if args.metrics_out:
                tested = rows.filter(classify.split_bucket("id") >= args.train_percent)
                pred = forest.predict(made, tested).select("target", "predicted").persist()
                for name, table in {"metrics": metrics.accuracy(pred, "target", "predicted"),
                                    "report": metrics.classification_report(pred, "target", "predicted"),
                                    "confusion": metrics.confusion(pred, "target", "predicted")}.items():
                    files.write_csv(table, f"{args.metrics_out.rstrip('/')}/{name}", mode="overwrite", single_file=True)
                pred.unpersist()
            return
        trained = classify.train_category_model(
            rows, classifier=args.classifier, num_trees=args.trees, max_bins=args.max_bins,
            train_percent=args.train_percent, seed=args.seed, smoothing=args.smoothing, partitions=args.partitions)
        classify.save(trained.model, args.model)
        if args.metrics_out:
            pred = trained.predictions.select("target", "predictedLabel", "indexedLabel", "prediction").persist()
            tables = {"metrics": classify.evaluate(pred),
                      "report": metrics.classification_report(pred, "target", "predictedLabel"),
                      "confusion": metrics.confusion(pred, "target", "predictedLabel")}
            for name, table in tables.items():
                files.write_csv(table, f"{args.metrics_out.rstrip('/')}/{name}", mode="overwrite", single_file=True)
            pred.unpersist()
    elif job == "top-blocks":
        _sink(sketches.top_values(inc, "hundred_block", args.k), args.out, args)
    elif job == "save-table":
        catalog_tables.save_bucketed(inc, args.name, args.buckets, path=args.path)
    elif job == "knn":
        rows = classify.training_rows(inc, include=None, exclude=classify.REFERENCE_EXCLUDED)
        tables = classify.label_tables(rows, ["target", "neighbourhood", "hundred_block"])
        rows = classify.encode(rows, "target", tables["target"], "label")
        rows = classify.encode(rows, "neighbourhood", tables["neighbourhood"], "nbr")
        rows = classify.encode(rows, "hundred_block", tables["hundred_block"], "hb")
        rows = rows.withColumn("bucket", classify.split_bucket("id"))
        train = rows.filter(F.col("bucket") < args.train_percent)
        test = rows.filter(F.col("bucket") >= args.train_percent)
        pred = knn.knn_predict(train, test, ["year", "month", "hour", "nbr", "hb"], "label", k=args.k)
        pred = classify.decode(pred, "prediction", tables["target"], "predicted")
        pred = pred.select("id", "target", "predicted").persist()
        _sink(pred, args.out, args, name="predictions")
        _sink(metrics.confusion(pred, "target", "predicted"), args.out, args, name="confusion")
        _sink(metrics.classification_report(pred, "target", "predicted"), args.out, args, name="report")
        _sink(metrics.accuracy(pred, "target", "predicted"), args.out, args, name="accuracy")
        pred.unpersist()


def main() -> None:
    run(sys.argv[1:])


if __name__ == "__main__":
    main()
