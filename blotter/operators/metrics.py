"""Classification metrics as aggregates over a predictions frame
``(label, prediction)``.

The confusion aggregate has one row per ``(label, prediction)`` pair
actually seen, tiny next to the predictions; per-class precision, recall,
F1 and support are re-aggregations of it.  Accuracy is one global
aggregate, never-predicted classes one ``exceptAll`` of distinct labels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Long confusion table ``(label, prediction, count bigint)``."""
    return (pred.select(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
            .groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("count")))


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes: Sequence[str] | None = None) -> DataFrame:
    """Wide confusion matrix: one row per true label, one column per class
    (0 where a pair never occurs), ``unpredicted`` for rows without a
    prediction if there are any; rows without a label are left out.

    The classes are the caller's, or come from the confusion table (one row
    per pair of classes, checkpointed), never from the predictions."""
    table = confusion(pred, label, prediction).filter(F.col("label").isNotNull())
    if classes is None:
        table = cut_lineage(table)
        seen = table.select("label").union(table.select("prediction")).distinct()
        classes = sorted(r[0] for r in seen.filter(F.col("label").isNotNull()).collect())
    cells = [F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("count"))), F.lit(0)).cast("bigint").alias(str(c)) for c in classes]
    none = F.coalesce(F.sum(F.when(F.col("prediction").isNull(), F.col("count"))), F.lit(0)).cast("bigint").alias("unpredicted")
    wide = table.groupBy("label").agg(*cells, none)
    return wide if not wide.filter("unpredicted > 0").isEmpty() else wide.drop("unpredicted")


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, precision, recall, f1, support bigint)`` for every class
    that is a true or a predicted label; 0.0 where undefined.  A null
    prediction is a miss of its label and no class; rows without a label
    are left out."""
    c = confusion(pred, label, prediction).filter(F.col("label").isNotNull())
    tp = c.filter(F.col("label") == F.col("prediction")).select("label", F.col("count").alias("tp"))
    support = c.groupBy("label").agg(F.sum("count").alias("support"))
    predicted = c.filter(F.col("prediction").isNotNull()).groupBy(F.col("prediction").alias("label")).agg(F.sum("count").alias("predicted"))
    classes = support.select("label").union(predicted.select("label")).distinct()
    r = (classes.join(tp, "label", "left").join(support, "label", "left").join(predicted, "label", "left")
         .fillna(0, ["tp", "support", "predicted"]))
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    r = r.withColumns({"precision": precision, "recall": recall})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return r.select("label", "precision", "recall", f1.alias("f1"), F.col("support").cast("bigint").alias("support"))


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: ``accuracy`` (share of rows with label == prediction; a null
    on either side is a miss) and ``n`` (rows)."""
    hit = F.when(F.col(label) == F.col(prediction), F.lit(1)).otherwise(F.lit(0))
    return pred.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def unpredicted_classes(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """True labels that are never predicted: ``(label)``."""
    truth = pred.select(F.col(label).alias("label")).dropna().distinct()
    said = pred.select(F.col(prediction).alias("label")).distinct()
    return truth.exceptAll(said)
