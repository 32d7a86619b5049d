"""Readable rules of saved trees and forests: nodes, and paths from the root to each leaf, as rows.

A path is what must hold for a row to reach a leaf: for each feature it asks about one interval, or one set of
categories, whatever the number of tests on the way. Rules can be read, stored, compared and applied by joins,
without the model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.scratch import materialize

INFINITY = float("inf")


def nodes(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Nodes of a saved tree or forest as rows: ``tree`` (0 for a single one), ``node``, ``feature`` and
    ``threshold`` of its test, or the ``categories`` that go left of ``n_categories`` (NULL in a leaf and for the other
    kind of test), ``left``, ``right``, ``prediction`` and ``stats``, the weights of the classes."""
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" in saved.columns:
        saved = saved.select(F.col("treeID").alias("tree"), F.col("nodeData").alias("n"))
    else:
        saved = saved.select(F.lit(0).alias("tree"), F.struct("*").alias("n"))
    node = F.col("n")
    inner, test = node["leftChild"] >= 0, node["split"]
    ordered = test["numCategories"] < 0
    names = F.array(*[F.lit(c) for c in columns])
    return saved.select(
        "tree",
        node["id"].alias("node"),
        F.when(inner, F.get(names, test["featureIndex"])).alias("feature"),
        F.when(inner & ordered, F.get(test["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner & ~ordered, test["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner & ~ordered, test["numCategories"]).alias("n_categories"),
        F.when(inner, node["leftChild"]).alias("left"),
        F.when(inner, node["rightChild"]).alias("right"),
        node["prediction"].alias("prediction"),
        node["impurityStats"].alias("stats"),
    )


def _children(tree: DataFrame) -> DataFrame:
    """Every child with its ``parent`` and what a row must fulfil to get there: ``feature`` and either ``above``
    and ``at_most`` or ``among``, the categories."""
    inner = tree.filter(F.col("left").isNotNull())
    everything = F.transform(F.sequence(F.lit(0), F.col("n_categories") - 1), lambda c: c.cast("double"))
    ordered = F.col("categories").isNull()

    def side(child: str, above: Column, at_most: Column, among: Column) -> Column:
        return F.struct(
            F.col(child).alias("node"),
            F.when(ordered, above).alias("above"),
            F.when(ordered, at_most).alias("at_most"),
            F.when(~ordered, among).alias("among"),
        )

    left = side("left", F.lit(-INFINITY), F.col("threshold"), F.col("categories"))
    right = side("right", F.col("threshold"), F.lit(INFINITY), F.array_except(everything, F.col("categories")))
    return inner.select("tree", F.col("node").alias("parent"), "feature", F.inline(F.array(left, right)))


def conditions(tree: DataFrame) -> DataFrame:
    """A row per leaf and feature on its path: ``tree``, ``leaf``, ``feature``, ``above`` < value <= ``at_most``, or
    ``among``. All leaves climb to the root together, one join with their parents a level; the tests of one feature
    then become one interval or set."""
    children = materialize(_children(tree), "children")
    climbing = tree.filter(F.col("left").isNull()).select("tree", F.col("node").alias("leaf"), "node")
    steps = None
    while True:
        step = climbing.join(children, ["tree", "node"])
        step = materialize(step.select("tree", "leaf", "feature", "above", "at_most", "among", "parent"), "steps")
        if step.isEmpty():
            break
        steps = step if steps is None else steps.unionAll(step)
        climbing = step.select("tree", "leaf", F.col("parent").alias("node"))
    if steps is None:
        steps = step
    sets = F.collect_list("among")
    both = F.aggregate(F.slice(sets, 2, F.greatest(F.size(sets), F.lit(1))), F.get(sets, F.lit(0)), F.array_intersect)
    return steps.groupBy("tree", "leaf", "feature").agg(
        F.max("above").alias("above"),
        F.min("at_most").alias("at_most"),
        F.when(F.size(sets) > 0, F.array_sort(both)).alias("among"),
    )


def readable(tree: DataFrame) -> DataFrame:
    """One row per leaf: ``tree``, ``leaf``, ``rule`` as text (empty for a tree without tests) and ``prediction``."""
    feature, above, at_most = F.col("feature"), F.col("above"), F.col("at_most")
    low = F.when(above > -INFINITY, F.concat(feature, F.lit(" > "), above.cast("string")))
    high = F.when(at_most < INFINITY, F.concat(feature, F.lit(" <= "), at_most.cast("string")))
    some = F.concat(feature, F.lit(" in ("), F.array_join(F.transform("among", lambda c: c.cast("int").cast("string")), ", "), F.lit(")"))
    text = F.concat_ws(" and ", low, high, some)
    rule = F.concat_ws(" and ", F.sort_array(F.collect_list(text))).alias("rule")
    texts = conditions(tree).groupBy("tree", "leaf").agg(rule)
    leaves = tree.filter(F.col("left").isNull()).select("tree", F.col("node").alias("leaf"), "prediction")
    return leaves.join(texts, ["tree", "leaf"], "left").select(
        "tree", "leaf", F.coalesce("rule", F.lit("")).alias("rule"), "prediction"
    )


def reached(df: DataFrame, keys: list[str], columns: list[str], found: DataFrame, tree: DataFrame) -> DataFrame:
    """The leaf of each row in each tree, by its ``conditions`` (``found``): keys, ``tree``, ``leaf``, ``prediction``, ``stats``.

    Values meet the conditions of their feature in a join; a leaf is reached where all of its conditions
    hold, which one leaf of a tree does."""
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("_value")) for c in columns]))
    rows = df.select(*keys, values)
    value = F.col("_value")
    holds = F.when(F.col("among").isNull(), (value > F.col("above")) & (value <= F.col("at_most"))).otherwise(
        F.array_contains("among", value)
    )
    asked = found.groupBy("tree", "leaf").agg(F.count("*").alias("_asked"))
    met = rows.join(found, "feature").filter(holds).groupBy(*keys, "tree", "leaf").agg(F.count("*").alias("_met"))
    leaves = tree.filter(F.col("left").isNull()).select("tree", F.col("node").alias("leaf"), "prediction", "stats")
    there = met.join(asked, ["tree", "leaf"]).filter(F.col("_met") == F.col("_asked"))
    there = there.join(leaves, ["tree", "leaf"]).select(*keys, "tree", "leaf", "prediction", "stats")
    # A tree that is one leaf asks nothing and is reached by all.
    single = leaves.join(asked, ["tree", "leaf"], "left_anti")
    everywhere = F.lit(1).alias("_one")
    alone = df.select(*keys, everywhere).join(single.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return there.unionAll(alone.select(*there.columns))


def voted(leaves: DataFrame, keys: list[str]) -> DataFrame:
    """Prediction of a classifier from the leaves that its trees reach: the class with the greatest mean
    share, the first of equal ones."""
    total = F.aggregate("stats", F.lit(0.0), lambda a, b: a + b)
    share = F.posexplode(F.transform("stats", lambda s: s / total)).alias("_class", "_share")
    shares = leaves.select(*keys, "tree", share).groupBy(*keys, "_class").agg(
        F.sort_array(F.collect_list(F.struct("tree", "_share"))).alias("_shares")
    )
    # Added up in the order of the trees, as the model does.
    added = F.aggregate("_shares", F.lit(0.0), lambda a, b: a + b["_share"])
    best = F.max(F.struct(added.alias("_sum"), (-F.col("_class")).alias("_class")))
    return shares.groupBy(*keys).agg((-best["_class"]).cast("double").alias("prediction"))
