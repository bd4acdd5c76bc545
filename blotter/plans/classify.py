"""Incident-category classifiers on Spark ML.

* :func:`training_rows` selects and shapes the rows (category include or
  exclude lists, strict coordinate filter, complete rows only);
* :func:`train_category_model` fits string indexers on all rows, assembles
  ``year, month, hour, neighbourhood index, block index`` and trains a
  random forest (or multinomial naive Bayes) on a deterministic hash split;
* :func:`score` applies a saved or fitted pipeline to new rows;
* :func:`score_requests` is the batch form of the single-prediction form:
  it reports ``missing_input`` / ``unknown_input`` instead of failing;
* :func:`label_table` / :func:`encode` / :func:`decode` give alphabetical
  label codes (code = position in sorted distinct values).

Every step is distributed: indexers count values with an aggregate, the
forest trains level by level on executors, scoring is a map-only
``transform``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import capitalize
from ..operators.dims import DEFAULT_BROADCAST_ROWS, broadcast_checked, has_point
from ..session import cut_lineage

FEATURES = ["year", "month", "hour", "neighbourhood", "hundred_block"]
NUMERIC_FEATURES = ["year", "month", "hour"]

# The three categories the forest is trained on, and the
# categories the single-machine notebook leaves out.
REFERENCE_TARGETS = ("theft from vehicle", "mischief", "other theft")
REFERENCE_EXCLUDED = (
    "theft of vehicle",
    "theft of bicycle",
    "vehicle collision or pedestrian struck (with injury)",
    "vehicle collision or pedestrian struck (with fatality)",
    "break and enter commercial",
    "break and enter residential/other",
)


def split_bucket(key: str | Column, buckets: int = 100) -> Column:
    """Deterministic bucket ``0..buckets-1`` of a row key from its MD5 (the
    same on any engine and on every recomputation, unlike a random split)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substr(F.md5(k.cast("string")), F.lit(1), F.lit(8)), 16, 10).cast("bigint") % buckets


def training_rows(incidents: DataFrame, include: Sequence[str] | None = REFERENCE_TARGETS,
                  exclude: Sequence[str] | None = None, strict_coordinates: bool = True,
                  drop_blocks: Sequence[str] = ()) -> DataFrame:
    """``(id, year, month, hour, neighbourhood, hundred_block, target)``:
    rows complete in the columns that are used (these and the position; a
    missing neighbourhood point loses no row), target in ``include`` / not in
    ``exclude``, both coordinates non-zero when ``strict_coordinates``."""
    df = incidents.withColumnRenamed("type", "target").dropna(how="any", subset=["id", *FEATURES, "target", "x", "y"])
    if include is not None:
        df = df.filter(F.col("target").isin(list(include)))
    if exclude:
        df = df.filter(~F.col("target").isin(list(exclude)))
    if drop_blocks:
        df = df.filter(~F.col("hundred_block").isin(list(drop_blocks)))
    if strict_coordinates:
        df = df.filter(has_point("x", "y", strict=True))
    return df.select("id", *FEATURES, "target")


# Parts the training rows are dealt into; raise it with the number of rows.
TRAIN_PARTITIONS = 64


@dataclass
class TrainedModel:
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame


def _fit_indexers(rows: DataFrame) -> tuple[StringIndexerModel, StringIndexerModel]:
    """Label indexer and one two-column indexer for the place features (one
    pass over the rows for both place columns)."""
    label = StringIndexer(inputCol="target", outputCol="indexedLabel", handleInvalid="keep").fit(rows)
    places = StringIndexer(inputCols=["neighbourhood", "hundred_block"], outputCols=["indexedNbr", "indexedHb"],
                           handleInvalid="keep").fit(rows)
    return label, places


def train_category_model(rows: DataFrame, classifier: str = "rf", num_trees: int = 10,
                         max_bins: int | None = None, train_percent: int = 80, seed: int = 42,
                         smoothing: float = 1.0, partitions: int = TRAIN_PARTITIONS) -> TrainedModel:
    """Fit the category pipeline on ``rows`` (from :func:`training_rows`).

    Indexers are fitted on all rows (so every label and place has a code),
    the split is ``split_bucket(id) < train_percent``.  The forest's
    ``maxBins`` defaults to the block cardinality + 1, because the block
    index is a categorical feature and Spark needs one bin per category.

    The forest draws its bootstrap samples per input partition, so the
    training rows are first hash-partitioned into ``partitions`` parts and sorted
    by ``id`` (one shuffle): the same rows, seed and ``partitions`` give the same
    model whatever the layout of the input and the settings of the session."""
    if rows.isEmpty():
        raise ValueError("no training rows (check the category list and the coordinate filter)")
    label, places = _fit_indexers(rows)
    nbr_labels, hb_labels = places.labelsArray
    if max_bins is None:
        max_bins = max(32, len(hb_labels) + 1, len(nbr_labels) + 1)
    assembler = VectorAssembler(inputCols=NUMERIC_FEATURES + ["indexedNbr", "indexedHb"],
                                outputCol="indexedFeatures", handleInvalid="keep")
    if classifier == "rf":
        est = RandomForestClassifier(labelCol="indexedLabel", featuresCol="indexedFeatures", numTrees=num_trees,
                                     maxBins=max_bins, seed=seed)
    elif classifier == "nb":
        est = NaiveBayes(labelCol="indexedLabel", featuresCol="indexedFeatures", smoothing=smoothing,
                         modelType="multinomial")
    else:
        raise ValueError(f"unknown classifier {classifier!r}")
    to_label = IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=label.labelsArray[0])
    bucket = split_bucket("id")
    train = rows.filter(bucket < train_percent).repartition(partitions, "id").sortWithinPartitions("id")
    test = rows.filter(bucket >= train_percent)
    model = Pipeline(stages=[label, places, assembler, est, to_label]).fit(train)
    return TrainedModel(model, train, test, model.transform(test))


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row: accuracy, weighted precision/recall/F1, and precision and
    recall of label 0 (the most frequent category), from one cached frame."""
    pred = predictions.select("indexedLabel", "prediction").persist()
    try:
        out = {}
        for metric in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
            out[metric] = MulticlassClassificationEvaluator(
                labelCol="indexedLabel", predictionCol="prediction", metricName=metric).evaluate(pred)
        for metric in ("precisionByLabel", "recallByLabel"):
            out[metric + "0"] = MulticlassClassificationEvaluator(
                labelCol="indexedLabel", predictionCol="prediction", metricName=metric, metricLabel=0.0).evaluate(pred)
    finally:
        pred.unpersist()
    spark = predictions.sparkSession
    return spark.createDataFrame([tuple(float(v) for v in out.values())], [k for k in out])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Predicted category per row; ``target`` may be absent."""
    return model.transform(rows)


def score_requests(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Batch scoring of ``(request_id, year, month, hour, neighbourhood,
    hundred_block)`` requests -> ``(request_id, status, prediction)``.

    ``status``: ``missing_input`` if any field is null, ``unknown_input``
    if the neighbourhood or the block was never seen in training, else
    ``ok``; ``prediction`` is the capitalised category for ``ok`` rows and
    an empty string otherwise."""
    n_nbr, n_hb = (len(labels) for labels in model.stages[1].labelsArray)
    missing = F.lit(False)
    for c in FEATURES:
        missing = missing | F.col(c).isNull()
    filled = requests.select("request_id", *FEATURES, missing.alias("_missing"))
    # Null fields are replaced by placeholders so that every model type can
    # run; the status column marks those rows and their prediction is blank.
    placeholders = {"neighbourhood": "", "hundred_block": "", "year": 0, "month": 0, "hour": 0}
    scored = PipelineModel(stages=model.stages[1:]).transform(filled.fillna(placeholders))
    status = (F.when(F.col("_missing"), F.lit("missing_input"))
              .when((F.col("indexedNbr") >= n_nbr) | (F.col("indexedHb") >= n_hb), F.lit("unknown_input"))
              .otherwise(F.lit("ok")))
    return scored.select(
        "request_id",
        status.alias("status"),
        F.when(status == "ok", capitalize(F.col("predictedLabel"))).otherwise(F.lit("")).alias("prediction"),
    )


def label_table(df: DataFrame, col: str) -> DataFrame:
    """``(value, code int)``: alphabetical codes 0..n-1 of a column's
    distinct non-null values."""
    return label_tables(df, [col])[col]


def label_tables(df: DataFrame, cols: Sequence[str]) -> dict[str, DataFrame]:
    """:func:`label_table` for several columns from one pass over ``df``.

    Distributed: the distinct values are sorted by range partitioning and
    checkpointed; a code is the value's place in its partition plus the sizes
    of the partitions before it (one row per partition).  No list of values
    reaches the driver."""
    return _numbered(_long(df, cols).distinct(), cols, ["value"])


def frequency_table(df: DataFrame, col: str) -> DataFrame:
    """``(value, code int)``: codes 0..n-1 of a column's distinct non-null values, the most frequent first, equally frequent
    ones by value - the codes a string indexer gives, without a list of values on the driver."""
    return frequency_tables(df, [col])[col]


def frequency_tables(df: DataFrame, cols: Sequence[str]) -> dict[str, DataFrame]:
    """:func:`frequency_table` for several columns from one pass over ``df``."""
    counts = _long(df, cols).groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))
    return _numbered(counts, cols, [F.desc("n"), F.asc("value")])


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(col, value)`` per row and non-null column; ``col`` is the column's place in ``cols``."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("col"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)])).alias("v"))
    return long.select("v.col", "v.value").filter(F.col("value").isNotNull())


def _numbered(values: DataFrame, cols: Sequence[str], order: Sequence[str | Column]) -> dict[str, DataFrame]:
    """Code tables of distinct values, numbered per column in ``order``."""
    ordered = cut_lineage(values.repartitionByRange("col", *order).sortWithinPartitions("col", *order))
    placed = ordered.select("col", "value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    sizes = placed.groupBy("col", "part").agg(F.count(F.lit(1)).alias("size"), F.min("row").alias("first"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("col").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("col", "part", "first", before.alias("before"))
    codes = placed.join(broadcast_checked(offsets), ["col", "part"]).select(
        "col", "value", (F.col("row") - F.col("first") + F.col("before")).cast("int").alias("code"))
    return {c: codes.filter(F.col("col") == i).select("value", "code") for i, c in enumerate(cols)}


def save_label_table(table: DataFrame, path: str) -> None:
    """Label codes as parquet (the portable form of a label map)."""
    table.write.mode("overwrite").parquet(path)


def load_label_table(spark, path: str) -> DataFrame:
    return spark.read.schema("value string, code int").parquet(path)


def encode(df: DataFrame, col: str, table: DataFrame, out: str | None = None,
           max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Add ``out`` (default ``<col>_code``); null for values not in the
    table.  The table is broadcast if it has at most ``max_rows`` rows
    (checked); a larger one is joined as the planner sees fit."""
    out = out or f"{col}_code"
    t = table.select(F.col("value").alias(col), F.col("code").alias(out))
    return df.join(broadcast_checked(t, max_rows), col, "left")


def decode(df: DataFrame, code_col: str, table: DataFrame, out: str,
           max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Code -> value (left join; null for unknown codes)."""
    t = table.select(F.col("code").alias(code_col), F.col("value").alias(out))
    return df.join(broadcast_checked(t, max_rows), code_col, "left")
