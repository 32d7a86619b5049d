"""Machine learning over the documents, embeddings and line items."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.learning import classify, cluster, features, metrics, recommend, rules
from millrace.operators.quality import fill_nulls
from millrace.plans.registry import query
from millrace.scratch import materialize, scratch_path
from millrace.tables import table

SPLIT = [0.8, 0.2]
SEED = 57
TEXT_COLUMNS = ["n_chars", "n_words", "n_lines"]
LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Size measures of every document."""
    documents = table(spark, sf, "documents").select(
        "doc_id",
        "lang",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
    )
    return fill_nulls(documents, dict.fromkeys(TEXT_COLUMNS, 0.0))


def _labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Size measures of every labelled document; the label is its quality."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return _documents(spark, sf).join(labels, "doc_id")


def _embedded(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )


def _split(df: DataFrame, key: str) -> list[DataFrame]:
    return features.hash_split(df, [key], SPLIT, SEED)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS f0, l_extendedprice AS f1,
           l_discount AS f2, l_tax AS f3
    FROM lineitem
""")
def ml_assemble(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.assemble(table(spark, sf, "lineitem"), LINE_COLUMNS)
    array = rows.select("l_orderkey", "l_linenumber", "l_partkey", vector_to_array("features").alias("f"))
    return array.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[F.get("f", F.lit(i)).alias(f"f{i}") for i in range(4)]
    )


def _drawn(*keys: str) -> str:
    """The draw of ``hash_split`` in SQL."""
    text = " || '|' || ".join([f"'{SEED}'", *[f"CAST({key} AS VARCHAR)" for key in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT) % 1000000"


@query(f"""
    SELECT o_orderkey, CASE WHEN {_drawn('o_orderkey')} < 800000 THEN 'train' ELSE 'test' END AS side FROM orders
""")
def ml_split(spark: SparkSession, sf: str) -> DataFrame:
    """Side of every order, by a hash of its key."""
    train, test = _split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
    return train.withColumn("side", F.lit("train")).unionAll(test.withColumn("side", F.lit("test")))


@query("""
    SELECT p_partkey, p_type, place - 1.0 AS label
    FROM part JOIN (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type)::DOUBLE AS place
                    FROM part GROUP BY p_type) USING (p_type)
""")
def ml_string_index(spark: SparkSession, sf: str) -> DataFrame:
    return features.index_labels(table(spark, sf, "part").select("p_partkey", "p_type"), "p_type")


def _logistic(spark: SparkSession, sf: str):
    rows = features.assemble(_labelled_documents(spark, sf), TEXT_COLUMNS)
    train, test = _split(rows.select("doc_id", "label", "features"), "doc_id")
    return classify.logistic().fit(train), test


@query()
def ml_logistic(spark: SparkSession, sf: str) -> DataFrame:
    model, test = _logistic(spark, sf)
    return classify.score(model, test, "doc_id", "label")


def _facts(*rows: DataFrame) -> DataFrame:
    """Columns of one-row tables as rows: their names and values."""
    flat = [
        row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("fact"), F.col(f"`{c}`").cast("bigint").alias("value")) for c in row.columns])))
        for row in rows
    ]
    return reduce(DataFrame.unionAll, flat)


def _bad_rows(scored: DataFrame) -> DataFrame:
    """Number of scored rows, and of those whose probabilities do not sum to one or whose prediction
    is not the likeliest class."""
    p = F.col("probability")
    total = F.aggregate(p, F.lit(0.0), lambda a, b: a + b)
    chosen = F.get(p, F.col("prediction").cast("int"))
    bad = (F.abs(total - 1) > 1e-9) | (chosen < F.array_max(p) - 1e-12)
    return scored.agg(F.count("*").alias("n_rows"), F.count_if(F.coalesce(bad, F.lit(True))).alias("n_bad"))


@query(f"""
    SELECT (SELECT count(*) FROM documents JOIN labels USING (doc_id) WHERE {_drawn('doc_id')} >= 800000) AS n_rows,
           0 AS n_bad, 'logistic' AS model
    UNION ALL
    SELECT (SELECT count(*) FROM embeddings WHERE {_drawn('vec_id')} >= 800000), 0, unnest(['tree', 'forest'])
    UNION ALL
    SELECT (SELECT count(*) FROM documents WHERE {_drawn('doc_id')} >= 800000), 0, 'indexed forest'
""")
def ml_score_facts(spark: SparkSession, sf: str) -> DataFrame:
    """How many held-out rows each classifier scored, and how many scores contradict themselves."""
    scored = {
        "logistic": ml_logistic,
        "tree": ml_decision_tree,
        "forest": ml_random_forest,
        "indexed forest": ml_indexed_forest,
    }
    facts = [_bad_rows(fn(spark, sf)).withColumn("model", F.lit(name)) for name, fn in scored.items()]
    return reduce(DataFrame.unionByName, facts)


@query("SELECT true AS starts_at_zero, 0 AS n_rises, true AS falls")
def ml_logistic_history(spark: SparkSession, sf: str) -> DataFrame:
    """The objective of the fit starts at iteration 0, never rises and ends lower."""
    model, _ = _logistic(spark, sf)
    history = classify.training_history(model)
    before = F.lag("objective").over(W.orderBy("iteration"))
    steps = history.withColumn("_rises", F.col("objective") > before + 1e-12)
    return steps.agg(
        (F.min("iteration") == 0).alias("starts_at_zero"),
        F.count_if("_rises").alias("n_rises"),
        (F.min_by("objective", "iteration") > F.max_by("objective", "iteration")).alias("falls"),
    )


@query()
def ml_logistic_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    """One row per feature, and one for the intercept."""
    model, _ = _logistic(spark, sf)
    rows = [(n, float(c)) for n, c in zip(TEXT_COLUMNS, model.coefficients)]
    return spark.createDataFrame([*rows, ("intercept", float(model.intercept))], "feature string, weight double")


@query()
def ml_logistic_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of the fitted model on the documents it has not seen."""
    model, test = _logistic(spark, sf)
    return metrics.classification_metrics(classify.score(model, test, "label"))


@query("""
    WITH p AS (
        SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y,
               CASE WHEN l_quantity <= 17 THEN 0 WHEN l_quantity <= 34 THEN 1 ELSE 2 END AS g
        FROM lineitem),
    c AS (
        SELECT k.c, (SELECT count(*) FROM p WHERE y = k.c) AS actual, (SELECT count(*) FROM p WHERE g = k.c) AS guessed,
               (SELECT count(*) FROM p WHERE y = k.c AND g = k.c) AS hit
        FROM (VALUES (0), (1), (2)) k(c)),
    m AS (SELECT actual, hit, hit / guessed AS pr, hit / actual AS re FROM c)
    SELECT round(sum(hit) / sum(actual), 9) AS accuracy,
           round(sum(pr * actual) / sum(actual), 9) AS weighted_precision,
           round(sum(re * actual) / sum(actual), 9) AS weighted_recall,
           round(sum(2 * pr * re / (pr + re) * actual) / sum(actual), 9) AS f1
    FROM m
""")
def ml_classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of a fixed rule that guesses the return flag from the quantity."""
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    guesses = table(spark, sf, "lineitem").select(
        F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2).alias("label"),
        F.when(quantity <= 17, 0).when(quantity <= 34, 1).otherwise(2).alias("prediction"),
    )
    found = metrics.classification_metrics(guesses)
    return found.select([F.round(c, 9).alias(c) for c in found.columns])


@query("""
    WITH scored AS (
        SELECT floor(n_chars / 50) AS score, quality FROM documents JOIN labels USING (doc_id)
        WHERE n_chars IS NOT NULL AND quality IS NOT NULL),
    steps AS (SELECT score, count(*) AS n, count(*) FILTER (quality = 1) AS hits FROM scored GROUP BY score),
    running AS (
        SELECT score, CAST(sum(n) OVER up AS BIGINT) AS n, CAST(sum(hits) OVER up AS BIGINT) AS hits
        FROM steps WINDOW up AS (ORDER BY score DESC))
    SELECT CAST(score AS BIGINT) AS threshold, n, hits, round(hits / n, 9) AS precision,
           round(hits / (SELECT count(*) FROM scored WHERE quality = 1), 9) AS recall
    FROM running
""")
def ml_threshold_curve(spark: SparkSession, sf: str) -> DataFrame:
    """Precision and recall of a fixed score, the length of a document in 50 characters, at every threshold."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = table(spark, sf, "documents").select("doc_id", F.floor(F.col("n_chars") / 50).alias("score")).join(labels, "doc_id")
    curve = metrics.threshold_curve(scored, "label", "score")
    return curve.withColumns({c: F.round(c, 9) for c in ("precision", "recall")})


@query()
def ml_decision_tree(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(_embedded(spark, sf), "vec_id")
    return classify.score(classify.decision_tree().fit(train), test, "vec_id", "label")


@query("SELECT unnest([0, 1, 2]) AS tree, 0 AS n_open, 0 AS n_astray")
def ml_forest_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Rules of a forest by tree: inner nodes without a test, and children that do not exist."""
    train, _ = _split(_embedded(spark, sf), "vec_id")
    path, width = scratch_path(spark, "forest"), len(train.first()["features"])
    classify.save_model(classify.random_forest(trees=3).fit(train), path)
    nodes = classify.rules(spark, path, [f"e{i}" for i in range(width)])
    children = nodes.select("tree", F.explode(F.array("left", "right")).alias("node")).filter("node IS NOT NULL")
    astray = children.join(nodes.select("tree", "node"), ["tree", "node"], "left_anti").groupBy("tree").count()
    unfinished = F.col("left").isNotNull() & (F.col("feature").isNull() | F.col("threshold").isNull())
    found = nodes.groupBy("tree").agg(F.count_if(unfinished).alias("n_open"))
    return found.join(astray, "tree", "left").select("tree", "n_open", F.coalesce("count", F.lit(0)).alias("n_astray"))


@query(f"""
    SELECT unnest(['tree', 'forest']) AS model, count(*) AS n_rows, 0 AS n_astray, 0 AS n_differ
    FROM embeddings WHERE {_drawn('vec_id')} >= 800000
""")
def ml_tree_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out rows whose prediction by the rules of a saved model, applied in joins, differs from the model's own,
    and rows that do not reach one leaf of each tree."""
    train, test = _split(_embedded(spark, sf), "vec_id")
    width = len(train.first()["features"])
    columns = [f"e{i}" for i in range(width)]
    wide = test.select("vec_id", vector_to_array("features").alias("f"))
    wide = wide.select("vec_id", *[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(columns)])
    facts = []
    for name, trees, kind in (("tree", 1, classify.decision_tree()), ("forest", 3, classify.random_forest(trees=3))):
        model, path = kind.fit(train), scratch_path(spark, name)
        classify.save_model(model, path)
        tree = materialize(rules.nodes(spark, path, columns), "nodes")
        found = materialize(rules.conditions(tree), "conditions")
        leaves = materialize(rules.reached(wide, ["vec_id"], columns, found, tree), "leaves")
        votes = rules.voted(leaves, ["vec_id"]).withColumnRenamed("prediction", "_voted")
        once = leaves.groupBy("vec_id").agg((F.countDistinct("tree") == trees).alias("_all"), (F.count("*") == trees).alias("_once"))
        mine = model.transform(test).select("vec_id", "prediction")
        checked = mine.join(votes, "vec_id", "left").join(once, "vec_id", "left")
        facts.append(
            checked.agg(
                F.count("*").alias("n_rows"),
                F.count_if(~F.coalesce(F.col("_all") & F.col("_once"), F.lit(False))).alias("n_astray"),
                F.count_if(~F.col("prediction").eqNullSafe(F.col("_voted"))).alias("n_differ"),
            ).withColumn("model", F.lit(name))
        )
    return reduce(DataFrame.unionAll, facts)


@query()
def ml_random_forest(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(_embedded(spark, sf), "vec_id")
    return classify.score(classify.random_forest(trees=3).fit(train), test, "vec_id", "label")


@query()
def ml_model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Tree and clusters scored by models that were saved and loaded."""
    rows = _embedded(spark, sf)
    train, test = _split(rows, "vec_id")
    path = scratch_path(spark, "tree")
    classify.save_model(classify.decision_tree().fit(train), path)
    scored = classify.score(DecisionTreeClassificationModel.load(path), test, "vec_id")
    path = scratch_path(spark, "kmeans")
    classify.save_model(cluster.fit_kmeans(rows, 4), path)
    placed = KMeansModel.load(path).transform(test).select("vec_id", F.col("prediction").alias("cluster"))
    return scored.select("vec_id", "prediction").join(placed, "vec_id")


@query(f"SELECT count(*) AS n_rows, 0 AS n_differ FROM embeddings WHERE {_drawn('vec_id')} >= 800000")
def ml_reload_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that a saved and loaded tree scores differently from the tree itself."""
    train, test = _split(_embedded(spark, sf), "vec_id")
    model, path = classify.decision_tree().fit(train), scratch_path(spark, "tree")
    classify.save_model(model, path)
    mine = classify.score(model, test, "vec_id")
    again = classify.score(DecisionTreeClassificationModel.load(path), test, "vec_id")
    again = again.select("vec_id", F.col("prediction").alias("_p"), F.col("probability").alias("_q"))
    same = (F.col("prediction") == F.col("_p")) & (F.col("probability") == F.col("_q"))
    return mine.join(again, "vec_id").agg(F.count("*").alias("n_rows"), F.count_if(~same).alias("n_differ"))


@query()
def ml_indexed_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Language of a document from its size measures: index, assemble and classify, reloaded."""
    train, test = _split(_documents(spark, sf), "doc_id")
    stages = classify.labelled_pipeline("lang", TEXT_COLUMNS, classify.random_forest(trees=20))
    path = scratch_path(spark, "forest")
    classify.save_model(stages.fit(train), path)
    return classify.score(PipelineModel.load(path), test, "doc_id", "lang", "label")


@query()
def ml_compare_models(spark: SparkSession, sf: str) -> DataFrame:
    """Tree and forest on one split, one row of metrics each."""
    train, test = _split(_embedded(spark, sf), "vec_id")
    train = train.cache()
    models = {"tree": classify.decision_tree(), "forest": classify.random_forest(trees=3)}
    rows = [
        metrics.classification_metrics(classify.score(model.fit(train), test, "label")).withColumn(
            "model", F.lit(name)
        )
        for name, model in models.items()
    ]
    train.unpersist()
    return rows[0].unionByName(rows[1])


def _ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings of parts by customers, from the quantities they ordered; one per pair. Keys are 32-bit
    numbers, as the factorization asks for; wider ones need dense ids first. Written once, since a fit
    reads its ratings more than once."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("int").alias("user_id"))
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").cast("int").alias("item_id"),
        F.least(F.lit(5.0), 1 + F.floor(F.col("l_quantity") / 10)).alias("rating"),
    )
    # By user and in order: hardly any pair comes twice, so nothing is gained by combining first, and neighbours of like keys
    # take less room here and in the shuffles of those who read them.
    pairs = lines.join(orders, "o_orderkey").repartition("user_id").groupBy("user_id", "item_id")
    single = pairs.agg(F.avg("rating").cast("float").alias("rating"))
    return materialize(single.sortWithinPartitions("user_id", "item_id"), "ratings")


@query()
def als_fit_predict(spark: SparkSession, sf: str) -> DataFrame:
    train, test = features.hash_split(_ratings(spark, sf), ["user_id", "item_id"], SPLIT, SEED)
    model = recommend.fit_als(train, "user_id", "item_id", "rating", copies=False)
    return model.transform(test)


@query()
def als_rmse(spark: SparkSession, sf: str) -> DataFrame:
    """Error of the recommender on ratings it has not seen."""
    return metrics.rmse(als_fit_predict(spark, sf), "rating", "prediction")


@query()
def als_recommend_titles(spark: SparkSession, sf: str) -> DataFrame:
    model = recommend.fit_als(_ratings(spark, sf), "user_id", "item_id", "rating", copies=False)
    titles = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    return recommend.recommend_titles(model, titles, "user_id", "item_id", "title")


@query("""
    SELECT 'users' AS fact, count(DISTINCT o_custkey) AS value FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    UNION ALL SELECT * FROM (VALUES ('most items', 5), ('copies', 0), ('beats mean', 1))
""")
def als_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Every user gets five different items, and the fit is nearer to its ratings than their mean is."""
    ratings = _ratings(spark, sf)
    model = recommend.fit_als(ratings, "user_id", "item_id", "rating", copies=False)
    best, _ = recommend.top_items(model.userFactors, model.itemFactors, 5)
    users = best.groupBy("id").agg(F.count("*").alias("n"), F.countDistinct("item").alias("_distinct"))
    error = F.col("prediction") - F.col("rating")
    beats = F.sqrt(F.avg(error * error)) < F.stddev_pop("rating")
    return _facts(
        users.agg(
            F.count("*").alias("users"), F.max("n").alias("most items"), F.sum(F.col("n") - F.col("_distinct")).alias("copies")
        ),
        model.transform(ratings).agg(beats.alias("beats mean")),
    )


@query("""
    WITH r AS (SELECT DISTINCT o_custkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
    SELECT 'pairs' AS fact, count(*) AS value FROM r
    UNION ALL SELECT 'users', count(DISTINCT o_custkey) FROM r
    UNION ALL SELECT 'recommended', 5 * count(DISTINCT o_custkey) FROM r
    UNION ALL SELECT * FROM (VALUES ('untitled', 0), ('out of order', 0), ('beats mean', 1))
""")
def als_key_facts(spark: SparkSession, sf: str) -> DataFrame:
    """The same ratings with text as users and numbers beyond 32 bits as items: all pairs are
    predicted, every user gets five known items, best first."""
    key, wide = F.concat(F.lit("customer "), F.col("user_id")), F.col("item_id").cast("bigint") + (1 << 40)
    ratings = _ratings(spark, sf).select(key.alias("who"), wide.alias("what"), "rating")
    fitted = recommend.fit_ratings(ratings, "who", "what", "rating", copies=False)
    best = materialize(fitted.recommend(5), "best")
    titles = table(spark, sf, "part").select((F.col("p_partkey") + (1 << 40)).alias("what"), F.col("p_name").alias("title"))
    after = F.lag("rating").over(W.partitionBy("who").orderBy("place"))
    ordered = best.join(titles, "what", "left").withColumn("_before", after)
    error = F.col("prediction") - F.col("rating")
    predicted = fitted.predict(ratings)
    beats = F.sqrt(F.avg(error * error)) < F.stddev_pop("rating")
    return _facts(
        predicted.agg(F.count("*").alias("pairs"), F.countDistinct("who").alias("users"), beats.alias("beats mean")),
        ordered.agg(
            F.count("*").alias("recommended"),
            F.count_if(F.col("title").isNull()).alias("untitled"),
            F.count_if(F.col("_before") < F.col("rating")).alias("out of order"),
        ),
    )


@query("""
    SELECT round(sqrt(avg((l_quantity * 1500 - l_extendedprice) * (l_quantity * 1500 - l_extendedprice))), 4) AS rmse
    FROM lineitem
""")
def regression_rmse(spark: SparkSession, sf: str) -> DataFrame:
    """Error of a fixed prediction: a price of 1500 per piece."""
    guesses = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction")
    )
    return metrics.rmse(guesses, "label", "prediction").select(F.round("rmse", 4).alias("rmse"))


@query()
def kmeans_assign(spark: SparkSession, sf: str) -> DataFrame:
    rows = _embedded(spark, sf)
    return cluster.fit_kmeans(rows, 4).transform(rows).select("vec_id", "prediction")


@query("""
    SELECT 'rows' AS fact, count(*) AS value FROM embeddings
    UNION ALL SELECT * FROM (VALUES ('clusters', 4), ('misplaced', 0), ('far from means', 0))
""")
def kmeans_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors that are nearer to another center than to their own, and whether the sum of squares is
    about that around the means of the clusters (the fit may stop a step before)."""
    rows = _embedded(spark, sf)
    model = cluster.fit_kmeans(rows, 4)
    placed = model.transform(rows).select(vector_to_array("features").alias("v"), "prediction")
    centers = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    squares = lambda a, b: F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
    )
    away = F.transform(centers, lambda c: squares(F.col("v"), c))
    own = F.get("_away", F.col("prediction"))
    far = placed.select("prediction", "v", away.alias("_away")).select(
        "prediction", "v", own.alias("_own"), F.array_min("_away").alias("_least")
    )
    entries = far.select("prediction", F.posexplode("v").alias("_i", "x"))
    means = entries.groupBy("prediction", "_i").agg(F.avg("x").alias("_mean"))
    least = entries.join(means, ["prediction", "_i"]).agg(F.sum((F.col("x") - F.col("_mean")) ** 2).alias("_sum"))
    sums = far.agg(F.sum("_own").alias("_sum")).unionAll(least)
    return _facts(
        far.agg(
            F.count("*").alias("rows"),
            F.countDistinct("prediction").alias("clusters"),
            F.count_if(F.col("_own") > F.col("_least") + 1e-9).alias("misplaced"),
        ),
        sums.agg((F.max("_sum") > F.min("_sum") * 1.02 + 1e-9).alias("far from means")),
    )


@query()
def kmeans_silhouette(spark: SparkSession, sf: str) -> DataFrame:
    rows = _embedded(spark, sf)
    value = metrics.silhouette(cluster.fit_kmeans(rows, 2).transform(rows))
    return spark.createDataFrame([(2, float(value))], "k int, silhouette double")


@query("""
    WITH p AS (SELECT vec_id, label % 4 AS c, embedding::DOUBLE[] AS v FROM embeddings),
    e AS (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM p),
    y AS (SELECT c, list(s ORDER BY i) AS ys FROM (SELECT c, i, sum(x) AS s FROM e GROUP BY c, i) GROUP BY c),
    st AS (SELECT c, count(*) AS n, sum(list_dot_product(v, v)) AS q FROM p GROUP BY c),
    d AS (
        SELECT p.vec_id, p.c, st.c AS o, st.n,
               list_dot_product(v, v) + (q - 2 * list_dot_product(v, ys)) / st.n AS away
        FROM p, st JOIN y USING (c)),
    ab AS (
        SELECT vec_id, c, max(n) FILTER (o = c) AS n, max(away * n / (n - 1)) FILTER (o = c) AS a, min(away) FILTER (o <> c) AS b
        FROM d GROUP BY vec_id, c)
    SELECT c AS cluster, count(*) AS n, round(avg((b - a) / greatest(a, b)), 9) AS silhouette FROM ab GROUP BY c
""")
def silhouette_by_cluster(spark: SparkSession, sf: str) -> DataFrame:
    """Silhouette of a fixed clustering of the vectors, by their label."""
    rows = table(spark, sf, "embeddings").select(
        (F.col("label") % 4).alias("cluster"), F.col("embedding").cast("array<double>").alias("v")
    )
    found = metrics.cluster_silhouettes(rows, "v", "cluster")
    return found.withColumn("silhouette", F.round("silhouette", 9))


@query("""
    SELECT unnest([2, 4, 6, 8, 10]) AS k, count(*) AS n_points, unnest([2, 4, 6, 8, 10]) AS n_clusters, 0 AS n_away FROM embeddings
""")
def kmeans_sweep_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Of each k, all fitted together: points, clusters, and centers that are not near the mean of their
    cluster (a fit may stop before its last step)."""
    points = materialize(table(spark, sf, "embeddings").select(F.col("embedding").cast("array<double>").alias("v")), "points")
    centers = cluster.fit_all(points, "v", [2, 4, 6, 8, 10], rounds=60)
    fitted = [(k, i, [float(x) for x in c]) for k, cs in centers.items() for i, c in enumerate(cs)]
    fitted = spark.createDataFrame(fitted, "k int, cluster int, center array<double>")
    found = cluster.moments(points, "v", centers).join(fitted, ["k", "cluster"])
    apart = F.zip_with("sums", "center", lambda s, c: F.abs(s / F.col("n") - c))
    return found.groupBy("k").agg(
        F.sum("n").alias("n_points"),
        F.count("*").cast("int").alias("n_clusters"),
        F.count_if(F.array_max(apart) > 0.05).cast("int").alias("n_away"),
    )


@query()
def kmeans_centers(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.centers(spark, cluster.fit_kmeans(_embedded(spark, sf), 4))


@query()
def kmeans_k_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.sweep_k(_embedded(spark, sf), [2, 4, 6, 8, 10])
