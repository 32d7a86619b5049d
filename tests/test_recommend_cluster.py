"""Top-n by norm bounds, factorization of any keys, and all k of k-means together."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from millrace.learning import cluster, metrics, recommend
from millrace.plans import learning
from millrace.scratch import materialize
from millrace.session import session_settings

FACTORS = "id int, features array<float>"


def factors(rng, n, rank=4, scale=1.0):
    return [(3 * i, [float(np.float32(rng.gauss(0, scale * (1 + 9 * (i % 17 == 0))))) for _ in range(rank)]) for i in range(n)]


def brute(users, items, n):
    found = []
    for u, x in users:
        scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in items)[:n]
        found += [(u, i, place, round(-s, 4)) for place, (s, i) in enumerate(scores, 1)]
    return sorted(found)


@pytest.mark.parametrize("n, block, group", [(5, 16, 40), (1, 7, 1000), (30, 8, 25), (500, 50, 60)])
def test_top_items_equal_all_pairs(spark, n, block, group):
    rng = random.Random(n)
    users, items = factors(rng, 90), factors(rng, 300)
    items += [(10_000 + i, items[5][1]) for i in range(4)]  # equal products
    users += [(20_000, [0.0] * 4)]
    best, scored = recommend.top_items(
        spark.createDataFrame(users, FACTORS), spark.createDataFrame(items, FACTORS), n, block, group
    )
    got = sorted((r.id, r.item, r.place, round(r.rating, 4)) for r in best.collect())
    expected = brute(users, items, n)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert all(abs(g[3] - e[3]) < 1e-3 for g, e in zip(got, expected))
    assert scored <= len(users) * len(items) and (n > 5 or scored < 0.9 * len(users) * len(items))


def test_no_items(spark):
    users = spark.createDataFrame(factors(random.Random(1), 3), FACTORS)
    best, scored = recommend.top_items(users, users.limit(0), 5)
    assert best.count() == 0 and scored == 0


def test_text_and_long_keys(spark):
    rng = random.Random(2)
    pairs = [(f"user {u}", (1 << 40) + i, float(1 + (u * i) % 5)) for u in range(30) for i in range(20) if rng.random() < 0.6]
    ratings = spark.createDataFrame([*pairs, (None, 1, 3.0)], "who string, what long, stars double")
    fitted = recommend.fit_ratings(ratings, "who", "what", "stars")
    predicted = fitted.predict(ratings)
    assert predicted.columns == ["who", "what", "stars", "prediction"] and predicted.count() == len(pairs)
    unknown = spark.createDataFrame([("nobody", 5)], "who string, what long")
    assert fitted.predict(unknown).count() == 0
    best = fitted.recommend(3)
    assert best.columns == ["who", "what", "rating", "place"]
    n_items = len({p[1] for p in pairs})
    assert best.count() == 3 * len({p[0] for p in pairs}) and n_items >= 3
    # The same as the model's own product over all pairs.
    mine = {(r.who, r.place): r.rating for r in best.collect()}
    numbers = {r.who: r._user_number for r in fitted.users.collect()}
    theirs = {r._user_number: [x.rating for x in r.recommendations] for r in fitted.model.recommendForAllUsers(3).collect()}
    for (who, place), rating in mine.items():
        assert math.isclose(rating, theirs[numbers[who]][place - 1], abs_tol=1e-4)


def test_predictions_are_those_of_the_model(spark):
    rng = random.Random(3)
    pairs = [(f"user {u}", (1 << 40) + i, float(1 + (u * i) % 5)) for u in range(30) for i in range(20) if rng.random() < 0.6]
    fitted = recommend.fit_ratings(spark.createDataFrame(pairs, "who string, what long, stars double"), "who", "what", "stars")
    numbers = spark.createDataFrame(pairs, "who string, what long, stars double").join(fitted.users, "who").join(fitted.items, "what")
    expected = {(r.who, r.what): r.prediction for r in fitted.model.transform(numbers).collect()}
    assert {(r.who, r.what): r.prediction for r in fitted.predict(numbers.select("who", "what")).collect()} == expected


def test_blocks_of_the_factorization_grow_with_the_ratings(spark):
    rng = random.Random(4)
    rows = [(7 * u, 3 * i, float(1 + (u * i) % 5)) for u in range(90) for i in range(40) if rng.random() < 0.5]
    ratings = materialize(spark.createDataFrame(rows, "u int, i int, r float"), "ratings")
    few = recommend.fit_als(ratings, "u", "i", "r", copies=False)
    many = recommend.fit_als(ratings, "u", "i", "r", copies=False, per_block=len(rows) // 15)
    assert few.userFactors.rdd.getNumPartitions() == few.itemFactors.rdd.getNumPartitions() == recommend.LEAST_BLOCKS
    assert many.userFactors.rdd.getNumPartitions() == many.itemFactors.rdd.getNumPartitions() == 16
    # All users and items have factors, and the fit is as near.
    off = [metrics.rmse(m.transform(ratings), "r", "prediction").first()[0] for m in (few, many)]
    assert many.userFactors.count() == 90 and many.itemFactors.count() == 40 and abs(off[0] - off[1]) < 0.1
    # Copies are averaged, so that they change nothing.
    twice = recommend.fit_als(ratings.unionAll(ratings), "u", "i", "r")
    mine, theirs = ({(x.u, x.i): x.prediction for x in m.transform(ratings).collect()} for m in (few, twice))
    assert all(math.isclose(mine[k], theirs[k], abs_tol=1e-3) for k in mine) and len(mine) == len(theirs) == len(rows)


def test_ratings_of_a_user_lie_together(spark):
    with session_settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        ratings = learning._ratings(spark, "/root/testdata/sf0.001")
        placed = ratings.withColumn("file", F.input_file_name())
        files = placed.groupBy("user_id").agg(F.countDistinct("file").alias("n"))
        assert files.agg(F.max("n")).first()[0] == 1 and placed.select("file").distinct().count() > 1
    # One row a pair, and in order inside a file.
    assert ratings.count() == ratings.select("user_id", "item_id").distinct().count()
    by_file = {}
    for row in placed.collect():
        by_file.setdefault(row.file, []).append((row.user_id, row.item_id))
    assert all(keys == sorted(keys) for keys in by_file.values())


def test_predictions_lie_by_user(spark):
    pairs = [(f"user {u}", (1 << 40) + i, float(1 + (u * i) % 5)) for u in range(12) for i in range(8)]
    ratings = spark.createDataFrame(pairs, "who string, what long, stars double")
    fitted = recommend.fit_ratings(ratings, "who", "what", "stars", copies=False, max_iter=1)
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        counted = fitted.predict(ratings).groupBy("who").agg(F.count("prediction").alias("n"))
        plan = counted._jdf.queryExecution().executedPlan().toString()
        # One exchange of the pairs and one of the users' factors; none for the groups.
        assert plan.count("Exchange hashpartitioning(who") == 2
        assert {r.n for r in counted.collect()} == {8}


def test_users_travel_once_a_block_and_most_products_are_not_taken(spark):
    rng = np.random.default_rng(5)
    lengths = rng.uniform(0.8, 1.2, 6000)
    make = lambda n: (lambda x: x / np.linalg.norm(x, axis=1)[:, None])(rng.normal(0, 1, (n, 5)))
    x, y = make(300).astype(np.float32), (make(6000) * lengths[:, None]).astype(np.float32)
    frame = lambda m: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], FACTORS)
    best, scored = recommend.top_items(frame(x), frame(y), 5)
    products = x.astype(float) @ y.astype(float).T
    got = {(r.id, r.place): r.item for r in best.collect()}
    assert all(got[u, k + 1] == i for u in range(300) for k, i in enumerate(np.argsort(-products[u], kind="stable")[:5]))
    asked = recommend._asked(frame(x).selectExpr("*", "1.0D AS _length", f"CAST(NULL AS {recommend.BEST}) AS best"), np.array([1.2]), 0, 1, 5)
    assert asked.count() == 300 and scored < 0.5 * products.size


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(6)
    data = [([c + rng.gauss(0, 0.3), -c + rng.gauss(0, 0.3), rng.random()],) for c in (0, 5, 11, 20) for _ in range(60)]
    return spark.createDataFrame(data, "v array<double>").repartition(5).persist()


def test_all_k_in_one_scan_a_round(blobs):
    centers = cluster.fit_all(blobs, "v", [1, 2, 4], rounds=50)
    assert {k: len(c) for k, c in centers.items()} == {1: 1, 2: 2, 4: 4}
    for row in cluster.moments(blobs, "v", centers).collect():
        assert np.allclose(np.array(row.sums) / row.n, centers[row.k][row.cluster], atol=1e-6)
    assert sorted(round(c[0] / 5) for c in centers[4]) == [0, 1, 2, 4]


def test_sweep_equals_the_evaluator(blobs):
    features = blobs.select(array_to_vector("v").alias("features"))
    swept = {r.k: r.silhouette for r in cluster.sweep_k(features, [2, 4]).collect()}
    points = blobs
    for k in (2, 4):
        fitted = cluster.fit_all(points, "v", [2, 4])[k]
        placed = [(row.v, int(cluster._nearest(np.array([row.v]), fitted)[0])) for row in points.collect()]
        df = points.sparkSession.createDataFrame(placed, "v array<double>, prediction int")
        theirs = ClusteringEvaluator().evaluate(df.select(array_to_vector("v").alias("features"), "prediction"))
        assert math.isclose(swept[k], theirs, abs_tol=1e-9)
        mine = metrics.cluster_silhouettes(df, "v", "prediction").agg(F.sum(F.col("n") * F.col("silhouette")) / F.sum("n"))
        assert math.isclose(mine.first()[0], theirs, abs_tol=1e-9)
    assert swept[4] > swept[2]


def test_odd_clusters(spark):
    data = [([0.0], 0), ([0.0], 0), ([5.0], 1), ([1.0], 2), ([1.5], 2)]
    df = spark.createDataFrame(data, "v array<double>, c int")
    found = {r.cluster: (r.n, r.silhouette) for r in metrics.cluster_silhouettes(df, "v", "c").collect()}
    assert found[0] == (2, 1.0) and found[1] == (1, 0.0)
    one = spark.createDataFrame([([1.0],)] * 5, "v array<double>")
    assert len(cluster.fit_all(one, "v", [3])[3]) == 1
    assert cluster.fit_all(one.limit(0), "v", [2]) == {}
