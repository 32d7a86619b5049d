"""Dense numbers, running totals, and what counts with them: labels, distinct bitmaps, threshold curves."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.learning import features, metrics
from millrace.operators import aggregates
from millrace.operators.numbering import numbered, numbered_keys, running_totals

WORDS = ["a", "B", "été", "", "zz", "a b"]


@pytest.fixture(scope="module")
def words(spark):
    rng = random.Random(3)
    data = [(i, rng.choice(WORDS * 3 + ["hot"] * 60), rng.randrange(-3, 4)) for i in range(3000)] + [(3000, None, None)]
    return spark.createDataFrame(data, "i long, w string, v int").repartition(7)


def test_numbers_follow_the_order(words):
    got = [(r.number, r.w, r.i) for r in numbered(words, ["w", "i"]).collect()]
    data = sorted(((r.w, r.i) for r in words.collect()), key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1]))
    assert sorted(got) == [(n, w, i) for n, (w, i) in enumerate(data)]


def test_numbered_keys(words):
    by_value = dict(rows(numbered_keys(words, "w")))
    assert by_value == {w: n for n, w in enumerate(sorted({*WORDS, "hot"}, key=str.encode))}
    counts = {r[0]: r[1] for r in words.groupBy("w").count().collect() if r[0] is not None}
    ranked = sorted(counts, key=lambda w: (-counts[w], w.encode()))
    assert dict(rows(numbered_keys(words, "w", "n", by_frequency=True))) == {w: n for n, w in enumerate(ranked)}


def test_running_totals(words):
    got = {r.i: (r.n, r.total) for r in running_totals(words.withColumn("one", F.lit(1)), ["w", "i"], {"one": "n", "v": "total"}).collect()}
    data = sorted(words.collect(), key=lambda r: (r.w is not None, (r.w or "").encode(), r.i))
    n = total = 0
    for r in data:
        n, total = n + 1, total + (r.v or 0)
        assert got[r.i] == (n, total)


def test_nothing_to_number(words):
    none = words.limit(0)
    assert numbered(none, ["i"]).count() == 0 and numbered_keys(none, "w").count() == 0
    assert running_totals(none, ["i"], {"v": "t"}).count() == 0


def test_labels_of_any_kind(spark, words):
    out = features.index_labels(words, "w")
    assert out.columns == [*words.columns, "label"] and out.count() == words.count()
    assert out.filter("w IS NULL").first()["label"] is None
    assert out.filter("w = 'hot'").first()["label"] == 0.0


def test_distinct_counts_do_not_repeat_rows(words):
    counted = aggregates.distinct_counts(words, ["w", "v"])
    assert "Expand" not in counted._jdf.queryExecution().toString()
    assert counted.first() == (8, 8, 3001)


def test_bitmaps_merge_to_distinct_counts(spark, words):
    bitmaps = aggregates.distinct_bitmaps(words, ["v"], "w").persist()
    assert rows(aggregates.merged_distinct(bitmaps, ["v"])) == rows(words.groupBy("v").agg(F.countDistinct("w")).filter("v IS NOT NULL"))
    assert aggregates.merged_distinct(bitmaps, []).first()[0] == 7
    wide = spark.range(100_000).select((F.col("id") % 70_000).alias("x"), (F.col("id") % 3).alias("g"))
    bitmaps = aggregates.distinct_bitmaps(wide, ["g"], "x")
    assert bitmaps.groupBy("g").count().first()[1] == 3
    assert aggregates.merged_distinct(bitmaps, []).first()[0] == 70_000


def test_threshold_curve(spark):
    rng = random.Random(4)
    data = [(rng.choice([0, 1]), rng.choice([0.1, 0.5, 0.5, 0.7, 0.9])) for _ in range(300)] + [(None, 0.5), (1, None)]
    df = spark.createDataFrame(data, "y int, s double").repartition(5)
    known = [(y, s) for y, s in data if y is not None and s is not None]
    for t, n, hits, precision, recall in metrics.threshold_curve(df, "y", "s").collect():
        above = [y for y, s in known if s >= t]
        assert (n, hits) == (len(above), sum(above))
        assert precision == pytest.approx(hits / n) and recall == pytest.approx(hits / sum(y for y, _ in known))
    assert metrics.threshold_curve(df.filter("s IS NULL"), "y", "s").count() == 0
