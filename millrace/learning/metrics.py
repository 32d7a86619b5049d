"""Quality of predictions, each as one DataFrame aggregate."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.numbering import running_totals


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy, weighted precision, weighted recall and F1 as one row.

    One pass counts the confusion table; all else works on its few rows. A class's precision is 0
    when it is never predicted.
    """
    cells = df.groupBy(F.col(label).alias("_l"), F.col(prediction).alias("_p")).agg(
        F.count("*").alias("_n")
    )
    # Each cell counts for its label's class and for its prediction's class.
    n, none = F.col("_n"), F.lit(0).cast("bigint")
    right = F.when(F.col("_l") == F.col("_p"), n).otherwise(none)
    as_label = F.struct(
        F.col("_l").alias("c"), n.alias("actual"), none.alias("guessed"), right.alias("right")
    )
    as_guess = F.struct(
        F.col("_p").alias("c"), none.alias("actual"), n.alias("guessed"), none.alias("right")
    )
    classes = (
        cells.select(F.inline(F.array(as_label, as_guess)))
        .groupBy("c")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "guessed", "right")])
    )
    per_class = classes.select(
        "actual", "right", _ratio("right", "guessed").alias("p"), _ratio("right", "actual").alias("r")
    )
    both = F.col("p") + F.col("r")
    f1 = F.when(both > 0, 2 * F.col("p") * F.col("r") / both).otherwise(0.0)
    per_class = per_class.withColumn("f", f1)
    return per_class.agg(
        (F.sum("right") / F.sum("actual")).alias("accuracy"),
        _weighted("p").alias("weighted_precision"),
        _weighted("r").alias("weighted_recall"),
        _weighted("f").alias("f1"),
    )


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def _weighted(name: str) -> Column:
    return F.sum(F.col(name) * F.col("actual")) / F.sum("actual")


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Root mean squared error as one row."""
    error = F.col(prediction) - F.col(label)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def silhouette(clustered: DataFrame, features: str = "features") -> float:
    """Mean silhouette by squared distance, computed from per-cluster sums in linear time."""
    return ClusteringEvaluator(featuresCol=features).evaluate(clustered)


def cluster_silhouettes(clustered: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Per cluster its number of points ``n`` and their mean ``silhouette``, by squared distance, in two scans.

    ``vector`` is an array of doubles, ``cluster`` any key. The first scan gives each cluster's number, sum
    of vectors and sum of squared lengths; from these the mean squared distance of a point to all points of a
    cluster follows, so the second scan compares points with clusters, not with points. Points meet the
    clusters as one array, as long as there are clusters."""
    points = clustered.select(F.col(cluster).alias("cluster"), F.col(vector).alias("_v"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    sized = points.groupBy("cluster").agg(F.count("*").alias("_n"), F.sum(dot(F.col("_v"), F.col("_v"))).alias("_squares"))
    entries = points.select("cluster", F.posexplode("_v").alias("_at", "_x"))
    sums = entries.groupBy("cluster", "_at").agg(F.sum("_x").alias("_x")).groupBy("cluster").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", "_x"))), lambda s: s["_x"]).alias("_sums")
    )
    stats = sized.join(sums, "cluster").agg(F.collect_list(F.struct("cluster", "_n", "_squares", "_sums")).alias("_all"))
    met = points.crossJoin(F.broadcast(stats))
    square = dot(F.col("_v"), F.col("_v"))
    away = F.transform("_all", lambda c: F.struct(
        c["cluster"].alias("cluster"), c["_n"].alias("n"),
        (square + (c["_squares"] - 2 * dot(F.col("_v"), c["_sums"])) / c["_n"]).alias("away"),
    ))
    measured = met.select("cluster", away.alias("_away"))
    own = F.get(F.filter("_away", lambda c: c["cluster"] == F.col("cluster")), F.lit(0))
    others = F.array_min(F.transform(F.filter("_away", lambda c: c["cluster"] != F.col("cluster")), lambda c: c["away"]))
    measured = measured.select("cluster", own["n"].alias("_n"), own["away"].alias("_own"), others.alias("_b"))
    inside = F.col("_own") * F.col("_n") / (F.col("_n") - 1)
    value = F.when((F.col("_n") > 1) & (F.greatest(inside, "_b") > 0), (F.col("_b") - inside) / F.greatest(inside, "_b"))
    return measured.groupBy("cluster").agg(
        F.count("*").alias("n"), F.avg(F.coalesce(value, F.lit(0.0))).alias("silhouette")
    )


def threshold_curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall at every threshold: a row per different ``score``, with the rows at or above it
    (``n``), those of them whose label is 1 (``hits``), ``precision`` and ``recall``. Rows without a score or label are left out.

    Rows of one score are counted first; the totals then run over score ranges, one task a range."""
    known = scored.select(F.col(score).alias("threshold"), (F.col(label) == 1).cast("bigint").alias("_hit")).dropna()
    steps = known.groupBy("threshold").agg(F.count("*").alias("_n"), F.sum("_hit").alias("_hits"))
    running = running_totals(steps, [F.desc("threshold")], {"_n": "n", "_hits": "hits"})
    everything = running.agg(F.max("hits").alias("_all"))
    hits = F.col("hits")
    recall = F.when(F.col("_all") > 0, hits / F.col("_all"))
    return running.crossJoin(F.broadcast(everything)).select(
        "threshold", "n", "hits", (hits / F.col("n")).alias("precision"), recall.alias("recall")
    )
