"""K-means clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Points that starting centers are drawn from, and how far centers may move that count as still.
SAMPLE = 2_000
TOLERANCE = 1e-9
SENT = pa.schema(
    [("k", pa.int32()), ("cluster", pa.int32()), ("n", pa.int64()), ("squares", pa.float64()), ("at", pa.int32()), ("sum", pa.float64())]
)


def fit_kmeans(df: DataFrame, k: int, seed: int = 73) -> KMeansModel:
    """K-means on the ``features`` column."""
    return KMeans().setK(k).setSeed(seed).fit(df)


def centers(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """Cluster centers as k rows."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def _sampled(points: DataFrame, vector: str, size: int) -> np.ndarray:
    """A bounded sample of the points: those with the least hashes, so the same for any partitioning."""
    drawn = points.select(vector).orderBy(F.xxhash64(vector), vector).limit(size).collect()
    return np.array([r[0] for r in drawn], np.float64)


def spread_centers(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` centers (fewer if there are fewer different points) by k-means++: each next one is drawn with
    the squared distance to the nearest so far as its weight."""
    rng = np.random.default_rng(seed)
    chosen = [sample[rng.integers(len(sample))]]
    away = ((sample - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k and away.sum() > 0:
        chosen.append(sample[rng.choice(len(sample), p=away / away.sum())])
        away = np.minimum(away, ((sample - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def fit_all(points: DataFrame, vector: str, ks: list[int], seed: int = 13, rounds: int = 20) -> dict[int, np.ndarray]:
    """Centers for every k, all fitted together: each round is one scan of the points, which gives the moments
    of all clusters of all k. A k is done when its centers no longer move, or after ``rounds``.

    Starting points are drawn from ``SAMPLE`` points. The driver holds the centers, sum(ks) vectors. Without
    points there are none.
    """
    sample = _sampled(points, vector, SAMPLE)
    centers = {k: spread_centers(sample, k, seed) for k in ks if len(sample)}
    moving = set(centers)
    for _ in range(rounds):
        if not moving:
            break
        found = moments(points, vector, {k: centers[k] for k in moving}).collect()
        before = {k: centers[k].copy() for k in moving}
        for row in found:
            centers[row.k][row.cluster] = np.array(row.sums) / row.n
        moving = {k for k in moving if not np.allclose(before[k], centers[k], rtol=0, atol=TOLERANCE)}
    return centers


def sweep_k(df: DataFrame, ks: list[int], seed: int = 13) -> DataFrame:
    """Silhouette of each k, one row per k. The features are kept for the rounds of the fit, which all k
    share; two more scans measure."""
    points = df.select(vector_to_array("features").alias("v")).persist(StorageLevel.MEMORY_AND_DISK)
    centers = fit_all(points, "v", ks, seed)
    held = moments(points, "v", centers).collect()
    measured = silhouettes(points, "v", centers, held).groupBy("k").agg(
        (F.sum("total") / F.sum("n")).alias("silhouette")
    )
    rows = [(r.k, r.silhouette) for r in measured.orderBy("k").collect()]
    points.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers**2).sum(axis=1) - 2 * x @ centers.T).argmin(axis=1)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def moments(points: DataFrame, vector: str, centers: dict[int, np.ndarray]) -> DataFrame:
    """``k``, ``cluster``, ``n``, ``sums`` of the vectors and ``squares``, the sum of their squared lengths, for the
    points nearest to each center. A task sends a row per cluster, so the size of the shuffle is that of the
    centers times the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros_like(c, np.float64) for k, c in centers.items()}
        squares = {k: np.zeros(len(c)) for k, c in centers.items()}
        counts = {k: np.zeros(len(c), np.int64) for k, c in centers.items()}
        for x in _matrices(batches):
            lengths = (x**2).sum(axis=1)
            for k, c in centers.items():
                here = _nearest(x, c)
                counts[k] += np.bincount(here, minlength=len(c))
                squares[k] += np.bincount(here, lengths, len(c))
                np.add.at(sums[k], here, x)
        rows = [
            {"k": k, "cluster": i, "n": int(counts[k][i]), "squares": float(squares[k][i]), "at": at, "sum": float(value)}
            for k in centers
            for i in np.flatnonzero(counts[k]).tolist()
            for at, value in enumerate(sums[k][i])
        ]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, SENT)

    sent = points.select(vector).mapInArrow(run, "k int, cluster int, n bigint, squares double, at int, sum double")
    places = sent.groupBy("k", "cluster", "at").agg(F.sum("n").alias("n"), F.sum("squares").alias("squares"), F.sum("sum").alias("sum"))
    return places.groupBy("k", "cluster").agg(
        F.max("n").alias("n"),
        F.max("squares").alias("squares"),
        F.transform(F.array_sort(F.collect_list(F.struct("at", "sum"))), lambda s: s["sum"]).alias("sums"),
    )


def silhouettes(points: DataFrame, vector: str, centers: dict[int, np.ndarray], held: list) -> DataFrame:
    """Sum (``total``) and number of the silhouettes of each task and ``k``, by squared distance, all k in one scan.

    ``held`` are the rows of ``moments``: the mean squared distance of a point to a cluster follows from them."""
    stats = {}
    for k in centers:
        mine = sorted((r.cluster, r.n, r.squares, r.sums) for r in held if r.k == k)
        stats[k] = [np.array(c, np.float64) for c in zip(*mine)] if mine else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, n = dict.fromkeys(centers, 0.0), 0
        for x in _matrices(batches):
            n += len(x)
            for k, c in centers.items():
                clusters, sizes, squares, sums = stats[k]
                own = np.searchsorted(clusters, _nearest(x, c))
                totals[k] += float(point_silhouettes(x, own, sizes, squares, sums).sum())
        rows = [{"k": k, "total": totals[k], "n": n} for k in centers]
        if n:
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("k", pa.int32()), ("total", pa.float64()), ("n", pa.int64())]))

    return points.select(vector).mapInArrow(run, "k int, total double, n bigint")


def point_silhouettes(x: np.ndarray, own: np.ndarray, sizes: np.ndarray, squares: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Silhouette of points ``x`` in clusters ``own``, of which only number, squares and sums are known."""
    away = (x**2).sum(axis=1)[:, None] + (squares / sizes)[None, :] - 2 * x @ (sums / sizes[:, None]).T
    rows = np.arange(len(x))
    size = sizes[own]
    inside = away[rows, own] * size / np.maximum(size - 1, 1)
    away[rows, own] = np.inf
    outside = away.min(axis=1)
    greater = np.maximum(inside, outside)
    known = (size > 1) & np.isfinite(outside) & (greater > 0)
    return np.where(known, (outside - inside) / np.where(known, greater, 1), 0.0)
