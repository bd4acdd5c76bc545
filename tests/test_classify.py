import numpy as np
from pyspark.sql import functions as F

from blotter.operators import metrics
from blotter.plans import classify, knn


def _brute_knn(train, queries, k):
    """Brute force with the same total order and vote rule."""
    out = {}
    rows = sorted(train)  # (features..., label) rows, duplicates allowed
    for q in set(queries):
        scored = sorted((sum((a - b) ** 2 for a, b in zip(q, r[:-1])), r[:-1], r[-1]) for r in rows)
        votes = {}
        for _d, _f, lab in scored[:k]:
            votes[lab] = votes.get(lab, 0) + 1
        best = sorted(votes.items(), key=lambda kv: (-kv[1], kv[0]))[0][0]
        out[q] = best
    return out


def test_knn_exact_against_brute_force(spark):
    rng = np.random.default_rng(7)
    train = [tuple(int(v) for v in rng.integers(0, 6, 3)) + (int(rng.integers(0, 3)),) for _ in range(300)]
    train += [(50, 50, 50, 1)] * 3 + [(49, 50, 52, 2)]          # far cluster: later rounds
    queries = [tuple(int(v) for v in rng.integers(0, 7, 3)) for _ in range(60)] + [(48, 48, 48), (100, 0, 100)]
    tdf = spark.createDataFrame(train, "a int, b int, c int, label int")
    qdf = spark.createDataFrame(queries, "a int, b int, c int")
    for k in (1, 5, 25):
        got = {(r.a, r.b, r.c): r.prediction
               for r in knn.knn_vectors(tdf, qdf, ["a", "b", "c"], "label", k=k, cell=2.0).collect()}
        assert got == _brute_knn(train, queries, k)


def test_knn_plan_has_no_cartesian(spark):
    tdf = spark.createDataFrame([(1, 1, 0), (2, 2, 1)], "a int, b int, label int")
    qdf = spark.createDataFrame([(1, 2)], "a int, b int")
    out = knn.knn_predict(tdf, qdf, ["a", "b"], "label", k=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert out.first().prediction in (0, 1)


def test_metrics(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"), ("a", "a")],
                                 "label string, prediction string")
    conf = {(r.label, r.prediction): r["count"] for r in metrics.confusion(pred).collect()}
    assert conf == {("a", "a"): 2, ("a", "b"): 1, ("b", "b"): 1, ("c", "b"): 1}
    rep = {r.label: r for r in metrics.classification_report(pred).collect()}
    assert abs(rep["a"].precision - 1.0) < 1e-12 and abs(rep["a"].recall - 2 / 3) < 1e-12
    assert abs(rep["b"].precision - 1 / 3) < 1e-12 and rep["b"].support == 1
    assert rep["c"].precision == 0.0 and rep["c"].f1 == 0.0
    assert abs(metrics.accuracy(pred).first().accuracy - 0.6) < 1e-12
    assert [r.label for r in metrics.unpredicted_classes(pred).collect()] == ["c"]
    wide = metrics.confusion_matrix(pred)
    assert wide.columns == ["label", "a", "b", "c"]


def _rows(spark, n=600):
    rng = np.random.default_rng(3)
    nbrs = ["strathcona", "sunset", "west end"]
    blocks = ["main st", "keefer st", "davie st", "oak st"]
    cats = ["mischief", "other theft", "theft from vehicle"]
    data = []
    for i in range(n):
        nb = int(rng.integers(0, 3))
        data.append((str(i), 2020 + int(rng.integers(0, 3)), int(rng.integers(1, 13)), int(rng.integers(0, 24)),
                     nbrs[nb], blocks[int(rng.integers(0, 4))], cats[(nb + int(rng.integers(0, 2))) % 3]))
    return spark.createDataFrame(data, "id string, year int, month int, hour int, neighbourhood string, "
                                       "hundred_block string, target string")


def test_forest_and_bayes_pipelines(spark, tmp_path):
    rows = _rows(spark)
    for clf in ("rf", "nb"):
        trained = classify.train_category_model(rows, classifier=clf)
        n_test = trained.test.count()
        assert trained.predictions.count() == n_test > 0
        labels = {r.predictedLabel for r in trained.predictions.select("predictedLabel").distinct().collect()}
        assert labels <= {"mischief", "other theft", "theft from vehicle"}
    m = classify.evaluate(trained.predictions).first()
    assert 0.0 <= m.accuracy <= 1.0 and 0.0 <= m.f1 <= 1.0
    path = str(tmp_path / "model")
    classify.save(trained.model, path)
    loaded = classify.load(path)
    req = spark.createDataFrame([("r1", 2019, 10, 23, "strathcona", "main st"),
                                 ("r2", 2019, 10, 23, "atlantis", "main st"),
                                 ("r3", 2019, 10, None, "sunset", "oak st")],
                                "request_id string, year int, month int, hour int, neighbourhood string, hundred_block string")
    got = {r.request_id: (r.status, r.prediction) for r in classify.score_requests(loaded, req).collect()}
    assert got["r1"][0] == "ok" and got["r1"][1] in ("Mischief", "Other theft", "Theft from vehicle")
    assert got["r2"] == ("unknown_input", "") and got["r3"] == ("missing_input", "")
    scored = classify.score(loaded, req.drop("request_id").filter(F.col("hour").isNotNull()).limit(1)
                            .filter(F.col("neighbourhood") == "strathcona"))
    assert scored.count() == 1


def test_split_is_deterministic(spark):
    rows = _rows(spark, 200)
    a = {r.id for r in rows.filter(classify.split_bucket("id") < 67).collect()}
    b = {r.id for r in rows.repartition(7).filter(classify.split_bucket("id") < 67).collect()}
    assert a == b and 100 < len(a) < 170


def test_label_codes_round_trip(spark):
    rows = _rows(spark, 50)
    table = classify.label_table(rows, "neighbourhood")
    assert sorted(map(tuple, table.collect())) == [("strathcona", 0), ("sunset", 1), ("west end", 2)]
    coded = classify.encode(rows, "neighbourhood", table, "code")
    back = classify.decode(coded, "code", table, "decoded")
    assert back.filter(F.col("decoded") != F.col("neighbourhood")).count() == 0


def test_label_table_save_load(spark, tmp_path):
    rows = _rows(spark, 30)
    table = classify.label_table(rows, "hundred_block")
    path = str(tmp_path / "labels")
    classify.save_label_table(table, path)
    back = classify.load_label_table(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))


def _brute_weighted(train, queries, k):
    """Brute force over raw rows with the library's total order."""
    out = {}
    for q in set(queries):
        scored = sorted((sum((a - b) * (a - b) for a, b in zip(q, r[:-1])), r[:-1], r[-1]) for r in train)
        votes = {}
        for _d, _f, lab in scored[:k]:
            votes[lab] = votes.get(lab, 0) + 1
        out[q] = sorted(votes.items(), key=lambda kv: (-kv[1], kv[0]))[0][0]
    return out


def test_knn_random_fixtures(spark):
    """Several seeds: integer and real-valued features, negative values,
    heavy duplication, sparse outliers, k above the training size."""
    for seed, real, k in [(1, False, 3), (2, True, 4), (3, False, 7), (4, True, 1), (5, False, 40)]:
        rng = np.random.default_rng(seed)
        n = 120
        if real:
            pts = np.round(rng.normal(0, 3, (n, 2)), 1)
            qs = np.round(rng.normal(0, 4, (25, 2)), 1)
        else:
            pts = rng.integers(-4, 5, (n, 2))
            qs = rng.integers(-6, 7, (25, 2))
        labels = rng.integers(0, 3, n)
        train = [(float(a), float(b), int(lab)) for (a, b), lab in zip(pts, labels)]
        train += train[:30]                                  # duplicates -> weights
        train += [(60.0, -60.0, 2)]                          # far outlier
        queries = [(float(a), float(b)) for a, b in qs] + [(59.0, -61.0)]
        schema = "a double, b double, label int"
        tdf = spark.createDataFrame(train, schema)
        qdf = spark.createDataFrame(queries, "a double, b double")
        got = {(r.a, r.b): r.prediction
               for r in knn.knn_vectors(tdf, qdf, ["a", "b"], "label", k=k).collect()}
        assert got == _brute_weighted(train, queries, k), (seed, real, k)


def test_forest_is_deterministic(spark):
    rows = _rows(spark, 400)
    a = classify.train_category_model(rows, classifier="rf", seed=7).predictions.select("id", "predictedLabel")
    b = classify.train_category_model(rows.repartition(3), classifier="rf", seed=7).predictions.select(
        "id", "predictedLabel")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_forest_does_not_depend_on_the_session(spark):
    rows = _rows(spark, 400)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in ("5", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out = classify.train_category_model(rows, classifier="rf", seed=7, partitions=6).predictions
            got.append(sorted(map(tuple, out.select("id", "predictedLabel").collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1]


def test_large_label_table_is_not_broadcast(spark):
    rows = spark.range(3000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    table = classify.label_table(rows, "v")
    got = {r.value: r.code for r in table.collect()}
    assert got == {v: i for i, v in enumerate(sorted(f"v{i}" for i in range(3000)))}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = classify.encode(rows, "v", table, max_rows=100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin v" not in plan and "SortMergeJoin" in plan


def test_knn_far_apart_integers_and_small_features(spark):
    rng = np.random.default_rng(11)
    for scale, kind in ((100_000, "int"), (1.0, "double")):
        cast = int if kind == "int" else float
        train = [(cast(rng.random() * scale), cast(rng.random() * scale), int(rng.integers(0, 3))) for _ in range(300)]
        queries = [(cast(rng.random() * scale), cast(rng.random() * scale)) for _ in range(60)]
        far = [(cast(50 * scale + i), cast(50 * scale)) for i in range(5)] if kind == "int" else [(40.0 + i, 40.0) for i in range(5)]
        tdf = spark.createDataFrame(train, f"a {kind}, b {kind}, label int")
        qdf = spark.createDataFrame(queries + far, f"a {kind}, b {kind}")
        got = {(r.a, r.b): r.prediction for r in knn.knn_vectors(tdf, qdf, ["a", "b"], "label", k=5).collect()}
        assert got == _brute_weighted(train, queries + far, 5)


def test_metrics_with_null_predictions(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", None), ("b", None), (None, "a"), ("c", "b")], "label string, prediction string")
    wide = {r.label: r for r in metrics.confusion_matrix(pred).collect()}
    assert metrics.confusion_matrix(pred).columns == ["label", "a", "b", "c", "unpredicted"]
    assert (wide["a"].a, wide["a"].unpredicted, wide["b"].unpredicted, wide["c"].b) == (1, 1, 1, 1)
    report = {r.label: r for r in metrics.classification_report(pred).collect()}
    assert set(report) == {"a", "b", "c"} and report["a"].support == 2 and report["a"].recall == 0.5
    assert sorted(r.label for r in metrics.unpredicted_classes(pred).collect()) == ["c"]
