"""Paths of trees and forests give what the models predict."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from millrace.learning import classify, features, rules
from millrace.scratch import scratch_path

COLUMNS = ["x", "y", "kind"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        x, y, kind = rng.uniform(-5, 5), rng.uniform(0, 10), float(rng.randrange(5))
        label = float((x > 1) + (kind in (1.0, 3.0)) * (y < 4))
        rows.append((i, label, x, y, kind))
    df = spark.createDataFrame(rows, "id int, label double, x double, y double, kind double")
    return features.assemble(df, COLUMNS).persist()


def saved(spark, model):
    path = scratch_path(spark, "model")
    classify.save_model(model, path)
    return rules.nodes(spark, path, COLUMNS).persist()


def predicted(model, data):
    return {r.id: r.prediction for r in model.transform(data).collect()}


@pytest.mark.parametrize(
    "model",
    [
        classify.decision_tree,
        lambda: DecisionTreeClassifier(maxDepth=8, seed=1),
        lambda: classify.random_forest(trees=7),
        lambda: classify.random_forest(trees=1, depth=1),
    ],
)
def test_rules_predict_what_the_model_does(spark, data, model):
    fitted = model().fit(data)
    tree = saved(spark, fitted)
    leaves = rules.reached(data, ["id"], COLUMNS, rules.conditions(tree), tree)
    assert leaves.groupBy("id", "tree").count().filter("count != 1").isEmpty()
    found = {r.id: r.prediction for r in rules.voted(leaves, ["id"]).collect()}
    assert found == predicted(fitted, data)


def test_categories_become_sets(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("abcdef"), rng.random()) for i in range(400)]
    rows = [(i, k, x, float(k in "bde" and x < 0.8)) for i, k, x in rows]
    df = spark.createDataFrame(rows, "id int, k string, x double, label double")
    # An indexed column has category metadata, so the tree asks for sets.
    stages = [StringIndexer(inputCol="k", outputCol="kind"), VectorAssembler(inputCols=["kind", "x"], outputCol="features")]
    ready = Pipeline(stages=stages).fit(df).transform(df)
    model = classify.decision_tree().fit(ready)
    path = scratch_path(spark, "model")
    classify.save_model(model, path)
    tree = rules.nodes(spark, path, ["kind", "x"])
    found = rules.conditions(tree)
    assert not found.filter(F.col("among").isNotNull()).isEmpty()
    got = {r.id: r.prediction for r in rules.voted(rules.reached(ready, ["id"], ["kind", "x"], found, tree), ["id"]).collect()}
    assert got == predicted(model, ready)
    assert all(" in (" in r.rule or "<=" in r.rule or ">" in r.rule for r in rules.readable(tree).collect())


def test_a_tree_without_tests(spark, data):
    one = data.withColumn("label", F.lit(0.0)).limit(20)
    tree = saved(spark, DecisionTreeClassifier(maxDepth=3).fit(one))
    assert [tuple(r) for r in rules.readable(tree).collect()] == [(0, 0, "", 0.0)]
    leaves = rules.reached(one, ["id"], COLUMNS, rules.conditions(tree), tree)
    assert leaves.count() == one.count()


def test_one_interval_per_feature(spark, data):
    tree = saved(spark, DecisionTreeClassifier(maxDepth=6, seed=1).fit(data))
    found = rules.conditions(tree)
    assert found.groupBy("tree", "leaf", "feature").count().filter("count > 1").isEmpty()
    assert found.filter("above >= at_most").isEmpty()
    nodes = classify.rules  # the same nodes, for a single tree as for a forest
    path = scratch_path(spark, "tree")
    classify.save_model(classify.decision_tree().fit(data), path)
    assert not nodes(spark, path, COLUMNS).filter("feature IS NOT NULL").isEmpty()
