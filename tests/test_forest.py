"""Forests as node tables: against Spark ML, against DuckDB's recursion, and a brute-force grower."""
import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.plans import classify, forest
from tests.test_classify import _rows

ML_FEATURES = [*classify.NUMERIC_FEATURES, "indexedNbr", "indexedHb"]


@pytest.fixture(scope="module")
def trained(spark):
    return classify.train_category_model(_rows(spark), classifier="rf", num_trees=7)


@pytest.fixture(scope="module")
def ml_nodes(spark, trained, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "forest")
    return forest.nodes_of(spark, trained.model.stages[3], path)


def test_node_table_scores_as_the_model_does(spark, trained, ml_nodes):
    rows = trained.predictions.select("id", "prediction", *ML_FEATURES)
    got = forest.score(rows, ml_nodes, ML_FEATURES, "by_table").collect()
    assert len(got) == trained.test.count() > 50
    assert all(r["by_table"] == r["prediction"] for r in got)
    facts = ml_nodes.agg(F.count("categories").alias("c"), F.count("threshold").alias("t"), F.count_distinct("tree").alias("n")).first()
    assert facts["c"] > 0 and facts["t"] > 0 and facts["n"] == 7


def test_node_table_in_a_recursive_query(trained, ml_nodes, tmp_path):
    ml_nodes.write.parquet(str(tmp_path / "nodes"))
    rows = trained.predictions.select("id", "prediction", F.array(*[F.col(c).cast("double") for c in ML_FEATURES]).alias("f"))
    rows.write.parquet(str(tmp_path / "rows"))
    got = duckdb.sql(f"""
      WITH RECURSIVE n AS (SELECT * FROM read_parquet('{tmp_path}/nodes/*.parquet')),
      x AS (SELECT * FROM read_parquet('{tmp_path}/rows/*.parquet')),
      walk AS (
        SELECT x.id, x.f, n.tree, n.node, n.feature, n.threshold, n.categories, n."left", n."right", n.counts FROM x, n WHERE n.node = 0
        UNION ALL
        SELECT w.id, w.f, n.tree, n.node, n.feature, n.threshold, n.categories, n."left", n."right", n.counts
        FROM walk w JOIN n ON n.tree = w.tree AND n.node = CASE
          WHEN w.f[w.feature + 1] <= w.threshold OR list_contains(w.categories, w.f[w.feature + 1]) THEN w."left" ELSE w."right" END
        WHERE w.feature IS NOT NULL),
      votes AS (SELECT id, tree, unnest(range(len(counts))) AS class, unnest(list_transform(counts, lambda c: c / list_sum(counts))) AS v
                FROM walk WHERE feature IS NULL),
      total AS (SELECT id, class, list_reduce(list(v ORDER BY tree), lambda a, b: a + b) AS v FROM votes GROUP BY id, class)
      SELECT id, arg_max(class, v) FROM (SELECT * FROM total ORDER BY id, class) GROUP BY id""").fetchall()
    want = {r["id"]: int(r["prediction"]) for r in trained.predictions.select("id", "prediction").collect()}
    assert dict(got) == want


def _brute(rows, features, classes, trees, depth, per_node):
    """The same forest, node by node on the driver."""
    digest = lambda *p: hashlib.md5("/".join(map(str, p)).encode()).hexdigest()
    steps = forest.poisson_steps()
    out = {}
    for tree in range(trees):
        held = [(r, sum(int(digest(r[0], tree)[:8], 16) >= s for s in steps)) for r in rows if None not in r]
        todo = [(0, [(r, w) for r, w in held if w])]
        while todo:
            node, mine = todo.pop()
            count = lambda part: [sum(w for r, w in part if r[-1] == k) for k in range(classes)]
            purity = lambda c: sum(float(x) * x for x in c) / sum(c)
            best = None
            if len(bin(node + 1)) - 3 < depth:
                for f in sorted(range(features), key=lambda i: digest(tree, node, i))[:per_node]:
                    for v in sorted({r[1 + f] for r, _ in mine}):
                        left, right = ([x for x in mine if (x[0][1 + f] <= v) == side] for side in (True, False))
                        if right:
                            gain = purity(count(left)) + purity(count(right))
                            if gain > purity(count(mine)) * (1 + forest.LEAST_GAIN) and (best is None or (-gain, f, v) < best[0]):
                                best = (-gain, f, v), left, right
            out[tree, node] = (best[0][1:] if best else (None, None), count(mine))
            if best:
                todo += [(2 * node + 1, best[1]), (2 * node + 2, best[2])]
    return out


@pytest.mark.parametrize("seed, features, classes, depth", [(1, 2, 2, 3), (2, 4, 3, 4)])
def test_grown_forest_against_brute_force(spark, seed, features, classes, depth):
    rng = np.random.default_rng(seed)
    names = [f"f{i}" for i in range(features)]
    rows = [(i, *(int(v) for v in rng.integers(0, 6, features)), int(rng.integers(0, classes))) for i in range(160)]
    rows += [(1000, *[None] * features, 0), (1001, *[1] * features, None), (None, *[1] * features, 0)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} int" for n in names) + ", y int")
    nodes = forest.grow(df, names, "y", classes, trees=3, depth=depth).collect()
    want = _brute(rows, features, classes, 3, depth, math.ceil(math.sqrt(features)))
    assert {(r["tree"], r["node"]): ((r["feature"], r["threshold"]), r["counts"]) for r in nodes} == want
    assert all((r["left"] is None) == (r["feature"] is None) for r in nodes)


def test_forest_does_not_depend_on_the_layout(spark):
    rows = _rows(spark)
    one = forest.train(rows.repartition(1), trees=3)
    other = forest.train(rows.repartition(7, "hour"), trees=3)
    key = lambda f: sorted(map(str, f.nodes.collect()))
    assert key(one) == key(other)


def test_train_predict_save_load(spark, tmp_path):
    rows = _rows(spark)
    made = forest.train(rows, trees=5)
    forest.save(made, str(tmp_path / "f"))
    back = forest.load(spark, str(tmp_path / "f"))
    asked = rows.limit(30)
    got = sorted(map(tuple, forest.predict(back, asked).select("id", "predicted").collect()))
    assert got == sorted(map(tuple, forest.predict(made, asked).select("id", "predicted").collect()))
    assert {p for _, p in got} <= {"mischief", "other theft", "theft from vehicle"}
    share = forest.predict(back, rows).filter("predicted = target").count() / rows.count()
    assert share > 0.4  # two of three categories are possible in a neighbourhood
    requests = spark.createDataFrame(
        [("a", 2020, 5, 3, "sunset", "oak st"), ("b", 2020, None, 3, "sunset", "oak st"), ("c", 2020, 5, 3, "nowhere", "oak st"),
         ("d", 2020, 5, 3, "sunset", "no st"), ("e", 2020, 5, 3, None, None)],
        "request_id string, year int, month int, hour int, neighbourhood string, hundred_block string")
    got = {r["request_id"]: (r["status"], r["prediction"]) for r in forest.score_requests(back, requests).collect()}
    assert {k: s for k, (s, _) in got.items()} == {"a": "ok", "b": "missing_input", "c": "unknown_input", "d": "unknown_input", "e": "missing_input"}
    assert got["a"][1] in ("Mischief", "Other theft", "Theft from vehicle") and got["c"][1] == ""


def test_no_training_rows(spark):
    with pytest.raises(ValueError, match="no training rows"):
        forest.train(_rows(spark).filter("1 = 0"))


def test_pure_and_constant_rows_make_single_leaves(spark):
    df = spark.createDataFrame([(i, 1, 2, 0) for i in range(50)], "id long, a int, b int, y int")
    nodes = forest.grow(df, ["a", "b"], "y", 2, trees=2).collect()
    assert {(r["node"], r["feature"]) for r in nodes} == {(0, None)}
    out = forest.score(spark.createDataFrame([(1, 1), (None, 1)], "a int, b int"), forest.grow(df, ["a", "b"], "y", 2, trees=2), ["a", "b"])
    assert sorted([tuple(r) for r in out.collect()], key=str) == [(1, 1, 0), (None, 1, None)]


def test_frequency_codes(spark):
    values = ["b"] * 3 + ["a"] * 3 + ["z"] * 9 + ["c", None, None]
    df = spark.createDataFrame([(v, v) for v in values], "v string, w string").repartition(5)
    got = {r["value"]: r["code"] for r in classify.frequency_table(df, "v").collect()}
    assert got == {"z": 0, "a": 1, "b": 2, "c": 3}
    both = classify.frequency_tables(df, ["v", "w"])
    assert {r["value"]: r["code"] for r in both["w"].collect()} == got
    assert classify.frequency_table(df.filter("1 = 0"), "v").collect() == []


def test_frequency_codes_equal_the_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(f"v{int(rng.integers(0, 400)) ** 2 // 400}",) for _ in range(3000)], "v string")
    labels = StringIndexer(inputCol="v", outputCol="i").fit(df).labels
    got = {r["value"]: r["code"] for r in classify.frequency_table(df, "v").collect()}
    assert got == {v: i for i, v in enumerate(labels)}
