import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.classification import DecisionTreeClassificationModel

from conftest import rows
from millrace.learning import classify, cluster, features, metrics, recommend
from millrace.plans import QUERIES
from millrace.scratch import scratch_path

SF = "/root/testdata/sf0.001"
POINTS = [(0.0, 4.0, 1.1), (0.0, 3.2, 0.2), (1.0, -2.0, 1.0), (1.0, -3.1, 0.3), (0.0, 5.5, 0.9), (1.0, -0.9, 0.1)]
MEALS = [(7, 1, 2), (7, 3, 5), (7, 4, 1), (8, 1, 1), (8, 2, 4), (8, 4, 2), (9, 2, 5), (9, 3, 4), (9, 5, 3), (9, 1, 2)]


@pytest.fixture(scope="module")
def points(spark):
    df = spark.createDataFrame(POINTS, "label double, x1 double, x2 double")
    return features.assemble(df, ["x1", "x2"]).select("label", "features")


def test_logistic_separates_the_points(points):
    scored = classify.score(classify.logistic().fit(points), points, "label")
    for row in scored.collect():
        assert row["prediction"] == row["label"] and math.isclose(sum(row["probability"]), 1.0)
    assert rows(metrics.classification_metrics(scored)) == [(1.0, 1.0, 1.0, 1.0)]


def test_tree_rules_and_reload(spark, points):
    model = classify.decision_tree().fit(points)
    assert "If (feature 0" in model.toDebugString and model.depth == 1
    path = scratch_path(spark, "tree")
    classify.save_model(model, path)
    classify.save_model(model, path)
    again = DecisionTreeClassificationModel.load(path)
    assert rows(classify.score(again, points, "label")) == rows(classify.score(model, points, "label"))


def test_metrics_equal_the_evaluator(spark):
    data = [(float(i % 3), float((i * i + i // 4) % 4)) for i in range(50)]
    df = spark.createDataFrame(data, ["label", "prediction"])
    mine = metrics.classification_metrics(df).first()
    evaluator = MulticlassClassificationEvaluator()
    names = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]
    theirs = [evaluator.evaluate(df, {evaluator.metricName: n}) for n in names]
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(mine, theirs))


def test_rmse_equals_the_evaluator(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (4.0, 4.0)], ["y", "p"])
    theirs = RegressionEvaluator(metricName="rmse", labelCol="y", predictionCol="p").evaluate(df)
    assert math.isclose(metrics.rmse(df, "y", "p").first()[0], theirs)


def test_hash_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(5000).selectExpr("id AS k")
    train, test = features.hash_split(df, ["k"], [0.8, 0.2], 57)
    a, b = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert not a & b and len(a | b) == 5000 and 3800 < len(a) < 4200
    again, _ = features.hash_split(df.repartition(13), ["k"], [0.8, 0.2], 57)
    assert {r[0] for r in again.collect()} == a
    other, _ = features.hash_split(df, ["k"], [0.8, 0.2], 58)
    assert {r[0] for r in other.collect()} != a


def test_random_split_is_complete(spark):
    parts = features.random_split(spark.range(500).repartition(4), [0.8, 0.2], 57)
    assert sum(p.count() for p in parts) == 500


def test_labels_by_frequency_then_alphabet(spark):
    df = spark.createDataFrame([(s,) for s in "ccbbbaadd"], ["s"])
    out = dict(rows(features.index_labels(df, "s").distinct()))
    assert out == {"b": 0.0, "a": 1.0, "c": 2.0, "d": 3.0}


def test_text_labels_through_index_assemble_classify(spark):
    df = spark.createDataFrame([("low", 1.0, 2.0), ("low", 1.5, 2.5), ("high", 8.0, 9.0), ("high", 9.0, 9.5)] * 5, ["s", "x", "y"])
    model = classify.labelled_pipeline("s", ["x", "y"], classify.random_forest(trees=3)).fit(df)
    out = classify.score(model, df, "label")
    assert all(r["label"] == r["prediction"] for r in out.collect())


def test_meals(spark):
    df = spark.createDataFrame(MEALS, "user_id int, meal_id int, rating int")
    model = recommend.fit_als(df, "user_id", "meal_id", "rating")
    error = metrics.rmse(model.transform(df), "rating", "prediction").first()[0]
    assert error < 0.5
    titles = spark.createDataFrame([(i, f"meal {i}") for i in range(1, 6)], ["meal_id", "title"])
    out = recommend.recommend_titles(model, titles, "user_id", "meal_id", "title", 3)
    assert out.columns == ["user_id", "title", "rating"] and out.count() == 9


def test_kmeans_golden(spark):
    data = [(-3.0, 0.0), (-2.0, 1.0), (-4.0, -1.0), (6.0, 20.0), (8.0, 22.0), (7.0, 24.0)]
    df = features.assemble(spark.createDataFrame(data, ["x", "y"]), ["x", "y"])
    model = cluster.fit_kmeans(df, 2)
    placed = [r["prediction"] for r in model.transform(df).select("prediction").collect()]
    assert len(set(placed[:3])) == 1 and len(set(placed[3:])) == 1 and placed[0] != placed[3]
    found = sorted(r["center"] for r in cluster.centers(spark, model).collect())
    assert [[round(v, 6) for v in c] for c in found] == [[-3.0, 0.0], [7.0, 22.0]]
    swept = cluster.sweep_k(df, [2, 4])
    assert [r["k"] for r in swept.collect()] == [2, 4] and all(-1 <= r["silhouette"] <= 1 for r in swept.collect())


def test_queries_without_sql(spark):
    scored = QUERIES["ml_logistic"](spark, SF).collect()
    assert scored and all(math.isclose(sum(r["probability"]), 1.0) for r in scored)
    sides = QUERIES["ml_split"](spark, SF)
    assert sides.count() == sides.select("o_orderkey").distinct().count() == 1500
    placed = QUERIES["kmeans_assign"](spark, SF)
    assert placed.count() == 500 and {r[0] for r in placed.select("prediction").distinct().collect()} == {0, 1, 2, 3}
    best = QUERIES["als_recommend_titles"](spark, SF).groupBy("user_id").count()
    assert best.filter("count > 5").count() == 0
    compared = QUERIES["ml_compare_models"](spark, SF).collect()
    assert sorted(r["model"] for r in compared) == ["forest", "tree"] and all(0 <= r["f1"] <= 1 for r in compared)
    quality = QUERIES["ml_logistic_metrics"](spark, SF).first()
    assert all(0 <= v <= 1 for v in quality)
    assert 0 < QUERIES["als_rmse"](spark, SF).first()[0] < 4
    weights = QUERIES["ml_logistic_coefficients"](spark, SF).collect()
    assert [r["feature"] for r in weights] == ["n_chars", "n_words", "n_lines", "intercept"]
