"""Order-independent sums and averages against exact fractions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregates import rating_stats
from millrace.operators.totals import exact_totals, rounded

INF, NAN = float("inf"), float("nan")


def totals(df, keys=()):
    v = F.col("v")
    return exact_totals(df, list(keys), {"total": v}, {"mean": v}, "n", {"low": v}, {"high": v})


def numbers(seed, n):
    rng = random.Random(seed)
    return [rng.choice([1, -1]) * rng.random() * 2.0 ** rng.randint(-80, 80) for _ in range(n)]


@pytest.mark.parametrize(
    "values",
    [
        [0.1] * 1000 + [1e9] + [-0.01] * 7,
        [1e17, 0.001, -1e17],
        [1e300, 1e-300, -1e300, 5e-324],
        [5e-324, 5e-324, 2.2250738585072014e-308],
        [1.7976931348623157e308, -1.7976931348623157e308, 3.0],
        [2.0**e for e in range(-1074, 1023, 7)] + [-(2.0**e) for e in range(-1070, 1020, 11)],
        [0.0, -0.0],
        [-1.0, -0.25, 2.0**53 + 2, -(2.0**62)],
        numbers(1, 3000),
        numbers(2, 3000) + [0.001] * 500,
    ],
)
def test_nearest_to_the_exact_sum_at_any_partitioning(spark, values):
    exact = sum(map(Fraction, values))
    found = set()
    for parts, some in ((1, values), (7, values[::-1]), (3, sorted(values))):
        df = spark.createDataFrame([(v,) for v in some], "v double").repartition(parts)
        row = totals(df).first()
        found.add((row.total, row.mean))
        assert (row.n, row.low, row.high) == (len(values), min(values), max(values))
    assert found == {(float(exact), float(exact) / len(values))}


def test_floats_and_integers(spark):
    df = spark.createDataFrame([(4.8, 3), (4.5, 4), (None, None)], "f float, i int")
    row = exact_totals(df, [], {"i": F.col("i")}, {"f": F.col("f")}, "n").first()
    assert row == (7.0, df.agg(F.avg("f")).first()[0], 3)
    dates = df.withColumns({"k": F.lit("a"), "d": F.lit("2024-01-01")})
    assert rating_stats(dates, "k", "f", "d").first() == ("a", 4.65, 3, "2024-01-01")


def test_nan_infinity_null_and_groups(spark):
    rows = [("a", 1.0), ("a", NAN), ("b", INF), ("b", 2.0), ("c", INF), ("c", -INF), ("d", None), (None, 3.0), (None, None), ("e", -INF)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    mine = {r.k: (r.total, r.mean, r.n) for r in totals(df, ["k"]).collect()}
    plain = df.groupBy("k").agg(F.sum("v"), F.avg("v"), F.count("*"))
    assert {k: str(v) for k, v in mine.items()} == {r[0]: str(tuple(r)[1:]) for r in plain.collect()}
    empty = totals(df.limit(0)).first()
    assert empty == (None, None, 0, None, None)
    assert totals(df.limit(0), ["k"]).count() == 0


def test_several_columns(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(3), rng.uniform(-1, 1) * 10 ** rng.randint(-3, 9), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "k int, a double, b double")
    found = exact_totals(df, ["k"], {"a": F.col("a"), "b": F.col("b")}, {"c": F.col("a") * F.col("b")})
    for k, a, b, c in found.collect():
        mine = [r for r in rows if r[0] == k]
        assert a == math.fsum(r[1] for r in mine) and b == math.fsum(r[2] for r in mine)
        assert c == math.fsum(r[1] * r[2] for r in mine) / len(mine)


def test_halves_are_rounded_up(spark):
    df = spark.createDataFrame([(1.0,), (1.01,)], "v double")
    assert totals(df).select(rounded(F.col("mean"), 2)).first()[0] == 1.01
