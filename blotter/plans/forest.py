"""Decision forests as tables: grown by group-bys, scored by joins.

A forest is a node table ``(tree, node, feature, threshold, categories, left, right, counts)``: a row goes to ``left`` if the
value of its feature is at most ``threshold``, or is one of ``categories``; a node without ``feature`` is a leaf, and
``counts`` are the class weights of the training rows that reached the node.  Node 0 is the root.

* :func:`grow` trains a forest.  Equal rows collapse into weighted vectors first; each level is one pass that counts (tree,
  node, feature, value, class) with a partial aggregate, accumulates the counts over the sorted values of a feature and takes
  the split with the least Gini impurity.  Counts are rows of a shuffle and not arrays in a task's memory, so a feature may have any
  number of values.  Bootstrap weights and the features of a node come from MD5, so that the forest depends on the rows and on
  nothing else.
* :func:`nodes_of` reads the node table of a Spark ML forest.
* :func:`score` takes the distinct vectors of the rows down all trees, one join with the node table per level, and adds up the
  leaves' class shares.
* :func:`train`, :func:`predict`, :func:`score_requests`, :func:`save` and :func:`load` wrap them for the category model, with
  the frequency codes of the places and of the categories as tables.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import capitalize
from ..operators.dims import broadcast_checked
from ..session import cut_lineage
from . import classify

#: Share by which a split must lower the impurity term, so that rounding alone never splits a node.
LEAST_GAIN = 1e-12
CODED_FEATURES = ["year", "month", "hour", "nbr", "hb"]


def _draw(*parts: Column | str) -> Column:
    """A number in 0 .. 2**32 - 1 from the MD5 of the parts."""
    text = F.concat_ws("/", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substr(F.md5(text), F.lit(1), F.lit(8)), 16, 10).cast("bigint")


def poisson_steps(mean: float = 1.0) -> list[int]:
    """Draws from which a row counts once, twice, ... in a bootstrap sample."""
    out, term, below = [], math.exp(-mean), 0.0
    while math.floor((below + term) * 2**32) < 2**32 - 1 and len(out) < 16:
        below += term
        out.append(math.floor(below * 2**32))
        term *= mean / len(out)
    return out


def bootstrap_weight(key: Column, tree: int) -> Column:
    """How often a row counts in a tree: Poisson(1), the same wherever the row lies."""
    draw = _draw(key, str(tree))
    return sum((F.when(draw >= step, 1).otherwise(0) for step in poisson_steps()), F.lit(0))


def _value(features: Sequence[str]) -> Column:
    """The value of the feature numbered in column ``feature``."""
    return F.element_at(F.array(*[F.col(f).cast("double") for f in features]), F.col("feature") + 1)


def _go_down(state: DataFrame, splits: DataFrame, features: Sequence[str], how: str) -> DataFrame:
    """One level: rows at a node of ``splits`` (one row per node, broadcast after a check of its size) move to its child."""
    kept = [c for c in state.columns if c != "node"]
    at = state.join(broadcast_checked(splits.select("tree", "node", "feature", "threshold")), ["tree", "node"], how)
    child = F.when(_value(features) <= F.col("threshold"), 2 * F.col("node") + 1).otherwise(2 * F.col("node") + 2)
    return at.select(*kept, F.when(F.col("feature").isNull(), F.col("node")).otherwise(child).alias("node"))


def grow(rows: DataFrame, features: Sequence[str], label: str, classes: int, key: str = "id", trees: int = 10, depth: int = 5,
         per_node: int | None = None) -> DataFrame:
    """Node table of a forest over numeric ``features`` and ``label`` codes ``0 .. classes - 1``.

    Rows with a null in a feature, the label or the key are left out.  A node tries ``per_node`` features (default: the
    square root of their number, rounded up); of equal splits the one with the smaller feature number and value wins."""
    features = list(features)
    per_node = per_node or math.ceil(math.sqrt(len(features)))
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("tree"), bootstrap_weight(F.col(key), t).alias("w")) for t in range(trees)]))
    weighted = (rows.select(key, *features, label).dropna().select(*features, F.col(label).alias("_y"), each.alias("_t"))
                .select(*features, "_y", "_t.tree", "_t.w").filter("w > 0")
                .groupBy("tree", *features, "_y").agg(F.sum("w").alias("w")))
    weighted = cut_lineage(weighted)
    numbers = range(classes)
    by_class = [F.sum(F.when(F.col("_y") == k, F.col("w")).otherwise(0)).alias(f"c{k}") for k in numbers]
    root = weighted.groupBy("tree").agg(*by_class).select(
        "tree", F.lit(0).cast("long").alias("node"), F.array(*[F.col(f"c{k}") for k in numbers]).alias("counts"))

    tried = F.slice(F.array_sort(F.array(*[
        F.struct(F.md5(F.concat_ws("/", F.col("tree").cast("string"), F.col("node").cast("string"), F.lit(str(i)))).alias("by"),
                 F.lit(i).alias("feature")) for i in range(len(features))])), 1, per_node)
    group = Window.partitionBy("tree", "node", "feature")
    upto = group.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def purity(names: list[str]) -> Column:
        """Sum of squared class weights over their sum; the split with the largest total has the least Gini impurity."""
        values = [F.col(n).cast("double") for n in names]
        return sum((v * v for v in values[1:]), values[0] * values[0]) / sum(values[1:], values[0])

    levels: list[DataFrame] = []
    for level in range(depth):
        state = weighted.withColumn("node", F.lit(0).cast("long"))
        for splits in levels:
            state = _go_down(state, splits, features, "inner")
        counted = (state.select("tree", "node", *features, "_y", "w", F.explode(tried).alias("_f"))
                   .select("tree", "node", *features, "_y", "w", F.col("_f.feature").alias("feature"))
                   .withColumn("value", _value(features)).groupBy("tree", "node", "feature", "value").agg(*by_class))
        sides = (counted.select("tree", "node", "feature", "value",
                                *[F.sum(f"c{k}").over(upto).alias(f"l{k}") for k in numbers],
                                *[F.sum(f"c{k}").over(group).alias(f"t{k}") for k in numbers])
                 .select("*", *[(F.col(f"t{k}") - F.col(f"l{k}")).alias(f"r{k}") for k in numbers])
                 .filter(sum((F.col(f"r{k}") for k in numbers), F.lit(0)) > 0))
        left, right, both = ([f"{side}{k}" for k in numbers] for side in "lrt")
        scored = sides.withColumn("score", purity(left) + purity(right)).filter(F.col("score") > purity(both) * (1 + LEAST_GAIN))
        best = F.max(F.struct(F.col("score"), (-F.col("feature")).alias("f"), (-F.col("value")).alias("v"),
                              F.array(*left).alias("l"), F.array(*right).alias("r"))).alias("b")
        splits = cut_lineage(scored.groupBy("tree", "node").agg(best).select(
            "tree", "node", (-F.col("b.f")).alias("feature"), (-F.col("b.v")).alias("threshold"), "b.l", "b.r"))
        if splits.isEmpty():
            break
        levels.append(splits)
    counts, split = root, None
    for splits in levels:
        counts = counts.unionByName(splits.select("tree", F.explode(F.array(
            F.struct((2 * F.col("node") + 1).alias("node"), F.col("l").alias("counts")),
            F.struct((2 * F.col("node") + 2).alias("node"), F.col("r").alias("counts")))).alias("c")).select("tree", "c.node", "c.counts"))
        own = splits.select("tree", "node", "feature", "threshold")
        split = own if split is None else split.unionByName(own)
    if split is None:
        nodes = counts.withColumns({"feature": F.lit(None).cast("int"), "threshold": F.lit(None).cast("double")})
    else:
        nodes = counts.join(split, ["tree", "node"], "left")
    child = lambda n: F.when(F.col("feature").isNotNull(), 2 * F.col("node") + n)
    return cut_lineage(nodes.select(
        "tree", "node", "feature", "threshold", F.lit(None).cast("array<double>").alias("categories"), child(1).alias("left"),
        child(2).alias("right"), F.transform("counts", lambda c: c.cast("double")).alias("counts")))


def nodes_of(spark: SparkSession, model: RandomForestClassificationModel, path: str) -> DataFrame:
    """Node table of a Spark ML forest, read from its saved form; the model is saved under ``path`` for that."""
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    # In the saved form a split lists a threshold (numCategories -1) or the categories that go left.
    ranged = n["split"]["numCategories"] == -1
    saved = spark.read.parquet(f"{path}/data")
    return saved.select(
        F.col("treeID").alias("tree"), n["id"].cast("long").alias("node"),
        F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner & ranged, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & ~ranged, n["split"]["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, n["leftChild"].cast("long")).alias("left"), F.when(inner, n["rightChild"].cast("long")).alias("right"),
        n["impurityStats"].alias("counts"))


def score(rows: DataFrame, nodes: DataFrame, features: Sequence[str], out: str = "prediction") -> DataFrame:
    """``rows`` with the class code of most votes in ``out`` (null if a feature is null).

    Votes are the class shares of a row's leaves, added up in tree order; on equal votes the smaller code wins.  Rows collapse
    to distinct vectors, which go down all trees at once: per level one join with the node table (its size is that of the
    trees, checked before it is broadcast) and, for splits by category, one with the categories that go left."""
    features = list(features)
    facts = nodes.agg(F.max("tree").alias("trees"), F.bool_or(F.col("categories").isNotNull()).alias("by_category")).first()
    if facts["trees"] is None:
        raise ValueError("the forest has no nodes")
    split = nodes.filter(F.col("feature").isNotNull())
    depth = _depth(nodes)
    inner = broadcast_checked(split.select("tree", "node", "feature", "threshold", "left", "right"))
    state = (rows.select(*features).dropna().distinct()
             .select("*", F.explode(F.sequence(F.lit(0), F.lit(facts["trees"]))).alias("tree"), F.lit(0).cast("long").alias("node")))
    if facts["by_category"]:
        to_left = broadcast_checked(split.select("tree", "node", F.explode("categories").alias("_value"), F.lit(True).alias("_in")))
    for _ in range(depth):
        state = state.join(inner, ["tree", "node"], "left").withColumn("_value", _value(features))
        goes_left = F.col("_value") <= F.col("threshold")
        if facts["by_category"]:
            state = state.join(to_left, ["tree", "node", "_value"], "left")
            goes_left = F.coalesce(goes_left, F.col("_in"), F.lit(False))
        child = F.when(goes_left, F.col("left")).otherwise(F.col("right"))
        state = state.select(*features, "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(child).alias("node"))
    weight = F.aggregate("counts", F.lit(0.0), lambda a, c: a + c)
    leaves = nodes.filter(F.col("feature").isNull()).select(
        "tree", "node", F.transform("counts", lambda c: c / weight).alias("share"))
    leaf = state.join(broadcast_checked(leaves), ["tree", "node"])
    by_tree = F.array_sort(F.collect_list(F.struct("tree", "share")))  # as many as trees
    votes = F.aggregate(
        F.col("_s"), F.transform(F.col("_s")[0]["share"], lambda _: F.lit(0.0)),
        lambda a, s: F.zip_with(a, s["share"], lambda x, y: x + y))
    best = (leaf.groupBy(*features).agg(by_tree.alias("_s")).select(*features, votes.alias("_v"))
            .select(*features, (F.array_position("_v", F.array_max("_v")) - 1).cast("int").alias(out)))
    return rows.join(best, features, "left")


def _depth(nodes: DataFrame) -> int:
    """Levels below the roots, counted along the parents: one small pass per level."""
    reached = nodes.filter("node = 0").select("tree", "node", "left", "right")
    links = broadcast_checked(nodes.select("tree", "node", "left", "right"))
    depth = 0
    while True:
        below = reached.filter(F.col("left").isNotNull()).select("tree", F.explode(F.array("left", "right")).alias("node"))
        if below.isEmpty():
            return depth
        depth += 1
        reached = cut_lineage(below.join(links, ["tree", "node"]))


@dataclass
class CategoryForest:
    """Node table, frequency codes ``(value, code)`` of both place columns, and of the categories."""

    nodes: DataFrame
    neighbourhoods: DataFrame
    blocks: DataFrame
    labels: DataFrame

    _PARTS = ("nodes", "neighbourhoods", "blocks", "labels")


def _coded(rows: DataFrame, forest: CategoryForest) -> DataFrame:
    """``rows`` with the place codes ``nbr`` and ``hb`` (null: a place not seen in training)."""
    coded = classify.encode(rows, "neighbourhood", forest.neighbourhoods, "nbr")
    return classify.encode(coded, "hundred_block", forest.blocks, "hb")


def train(rows: DataFrame, trees: int = 10, depth: int = 5, train_percent: int = 80, per_node: int | None = None) -> CategoryForest:
    """Category forest over ``rows`` (from :func:`classify.training_rows`): codes from all rows, trees from those with
    ``split_bucket(id) < train_percent``."""
    tables = classify.frequency_tables(rows, ["neighbourhood", "hundred_block", "target"])
    codes = [cut_lineage(t) for t in tables.values()]
    classes = codes[2].count()
    if not classes:
        raise ValueError("no training rows (check the category list and the coordinate filter)")
    forest = CategoryForest(None, *codes)
    part = classify.encode(rows.filter(classify.split_bucket("id") < train_percent), "target", forest.labels, "label")
    forest.nodes = grow(_coded(part, forest), CODED_FEATURES, "label", classes, trees=trees, depth=depth, per_node=per_node)
    return forest


def predict(forest: CategoryForest, rows: DataFrame, out: str = "predicted") -> DataFrame:
    """``rows`` with the predicted category (null if a field is null or a place unknown)."""
    scored = score(_coded(rows, forest), forest.nodes, CODED_FEATURES, "_code")
    return classify.decode(scored, "_code", forest.labels, out).select(*rows.columns, out)


def score_requests(forest: CategoryForest, requests: DataFrame) -> DataFrame:
    """``(request_id, status, prediction)`` as :func:`classify.score_requests` reports them."""
    missing = F.lit(False)
    for c in classify.FEATURES:
        missing = missing | F.col(c).isNull()
    scored = classify.decode(score(_coded(requests.select("request_id", *classify.FEATURES), forest), forest.nodes, CODED_FEATURES, "_code"),
                             "_code", forest.labels, "_said")
    status = (F.when(missing, "missing_input").when(F.col("nbr").isNull() | F.col("hb").isNull(), "unknown_input").otherwise("ok"))
    return scored.select("request_id", status.alias("status"),
                         F.when(status == "ok", capitalize(F.col("_said"))).otherwise(F.lit("")).alias("prediction"))


def save(forest: CategoryForest, path: str) -> None:
    """The four tables as Parquet under ``path``."""
    for part in CategoryForest._PARTS:
        getattr(forest, part).write.mode("overwrite").parquet(f"{path}/{part}")


def load(spark: SparkSession, path: str) -> CategoryForest:
    return CategoryForest(*[spark.read.parquet(f"{path}/{part}") for part in CategoryForest._PARTS])
