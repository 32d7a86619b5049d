import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import aggregates, joins, quality, ranking, unions
from millrace.operators.skew import Slots, split_join

PLANTS = [(21, "fig", 3), (22, "yew", 8), (22, "box", 1), (27, "ash", 5)]
GARDENS = [(21, "court"), (22, "north bed"), (25, "terrace")]


@pytest.fixture(scope="module")
def plants(spark):
    return spark.createDataFrame(PLANTS, ["garden_id", "plant", "height"])


@pytest.fixture(scope="module")
def gardens(spark):
    return spark.createDataFrame(GARDENS, ["garden_id", "name"])


def test_joins_on_a_shared_name(plants, gardens):
    assert joins.join_using(plants, gardens, "garden_id").count() == 3
    left = joins.join_using(plants, gardens, "garden_id", "left")
    assert left.columns == ["garden_id", "plant", "height", "name"]
    assert (27, "ash", 5, None) in rows(left)
    assert (25, None, None, "terrace") in rows(joins.join_using(plants, gardens, "garden_id", "right"))


def test_join_by_expression_keeps_both_keys(plants, gardens):
    renamed = gardens.withColumnRenamed("garden_id", "g_id")
    left = joins.join_on(plants, renamed, "garden_id", "g_id", "left")
    assert left.columns == ["garden_id", "plant", "height", "g_id", "name"] and left.count() == 4
    right = joins.join_on(plants, renamed, "garden_id", "g_id", "right")
    assert (None, None, None, 25, "terrace") in rows(right)


def test_star_join_with_bad_keys(spark):
    fact = spark.createDataFrame(
        [(1, '{"car_id":1,"agency_id":7}'), (2, '{"car_id":"abc","agency_id":7}'), (3, "broken"), (4, '{"car_id":9,"agency_id":7}')],
        ["rental_id", "info"],
    )
    cars = spark.createDataFrame([(1, '{"car_name":"Beetle"}')], ["car_id", "car_info"])
    agencies = spark.createDataFrame([(7, '{"agency_name":"North"}')], ["agency_id", "agency_info"])
    out = joins.star_join(
        fact, "info", ["rental_id"],
        [(cars, "car_id", "car_info", "car_name"), (agencies, "agency_id", "agency_info", "agency_name")],
    )
    assert rows(out) == [(1, "Beetle", "North")]


def test_unions(spark):
    a = spark.createDataFrame([(6, "kiln"), (8, "loom")], ["id", "name"])
    b = spark.createDataFrame([(8, "loom"), (9, "vise"), (9, "vise")], ["id", "name"])
    assert unions.union_all(a, b).count() == 5
    assert rows(unions.union_distinct(a, b)) == [(6, "kiln"), (8, "loom"), (9, "vise")]
    swapped = spark.createDataFrame([("anvil", 7)], ["name", "id"])
    assert rows(unions.union_by_name(a, swapped)) == [(6, "kiln"), (7, "anvil"), (8, "loom")]
    wider = spark.createDataFrame([(5, "lathe", "shed")], ["id", "name", "place"])
    assert (8, "loom", None) in rows(unions.union_by_name(wider, a, fill_missing=True))


def test_tide_levels(spark):
    data = [("quay", 1.2), ("lock", 2.9), ("quay", 0.7), ("weir", 3.3), ("lock", 3.1), ("quay", 0.9)]
    df = spark.createDataFrame(data, ["place", "level"])
    out = df.groupBy("place").agg(F.min("level"), F.count("*"))
    assert rows(out) == [("lock", 2.9, 2), ("quay", 0.7, 3), ("weir", 3.3, 1)]


VISITS = [
    ("w1", "Alm", 3.0, dt.date(2023, 1, 9)),
    ("w1", "Col", 4.25, dt.date(2023, 2, 3)),
    ("w2", "Alm", 3.5, dt.date(2023, 3, 8)),
    ("w2", "Fen", 2.5, dt.date(2023, 1, 30)),
    ("w2", "Col", 4.0, dt.date(2022, 12, 24)),
    ("w4", "Alm", 1.0, dt.date(2023, 3, 1)),
]


@pytest.fixture(scope="module")
def visits(spark):
    return spark.createDataFrame(VISITS, "walker string, hut string, score float, day date")


def test_rating_stats(visits):
    assert rows(aggregates.rating_stats(visits, "hut", "score", "day")) == [
        ("Alm", 2.5, 3, dt.date(2023, 3, 8)),
        ("Col", 4.13, 2, dt.date(2023, 2, 3)),
        ("Fen", 2.5, 1, dt.date(2023, 1, 30)),
    ]


def test_nested_documents(spark, visits):
    walkers = spark.createDataFrame([(f"w{i}", i * i) for i in range(1, 5)], ["walker", "age"])
    out = aggregates.nested_documents(walkers, visits, "walker", ["hut", "score", "day"], "visits")
    sizes = {r["walker"]: (r["part"], len(r["visits"] or [])) for r in out.collect()}
    assert sizes == {"w1": (0, 2), "w2": (0, 3), "w3": (0, 0), "w4": (0, 1)}
    assert out.schema["visits"].dataType.simpleString() == "array<struct<hut:string,score:float,day:date>>"


def test_map_reduce_pairs(spark):
    df = spark.createDataFrame([("t", 5), ("u", 9), ("t", 2), ("s", 4), ("s", 4)], ["k", "v"])
    assert rows(aggregates.sum_by_key(df, "k", "v")) == [("s", 8), ("t", 7), ("u", 9)]
    assert rows(aggregates.collect_items(df, ["k"], ["v"])) == [("s", 0, [4, 4]), ("t", 0, [2, 5]), ("u", 0, [9])]
    words = spark.createDataFrame([(w,) for w in "rain sun rain fog rain sun".split()], ["w"])
    assert rows(aggregates.group_count(words, "w")) == [("fog", 1), ("rain", 3), ("sun", 2)]


def test_multiples_of_five(spark):
    assert [r[0] for r in spark.range(100).filter("id % 5 = 0").orderBy("id").collect()] == list(range(0, 100, 5))


def _skewed(n=600, seed=3):
    """A third of all rows on one key, most of them copies of one item; some NULLs."""
    rng = random.Random(seed)
    out = [("hot", 7) for _ in range(n // 4)] + [("hot", rng.randint(0, 40)) for _ in range(n // 8)]
    out += [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None])) for _ in range(n // 2)]
    return out


@pytest.mark.parametrize("max_hot", [1, 50])
def test_large_groups_come_in_parts_and_stay_whole(spark, max_hot):
    data = _skewed()
    df = spark.createDataFrame(data, "k string, v int").repartition(6)
    out = aggregates.collect_items(df, ["k"], ["v"], "vs", max_items=20, rows_per_slot=5, max_hot=max_hot).collect()
    found = collections.Counter((r["k"], v) for r in out for v in r["vs"])
    assert found == collections.Counter(data)
    parts = collections.Counter(r["k"] for r in out)
    assert parts["hot"] > 3
    assert len({(r["k"], r["part"]) for r in out}) == len(out)


def test_many_copies_of_one_item_are_divided(spark):
    df = spark.range(1000).selectExpr("'k' AS k", "1 AS v")
    out = aggregates.collect_items(df, ["k"], ["v"], "vs", max_items=50).collect()
    assert sum(len(r["vs"]) for r in out) == 1000 and max(len(r["vs"]) for r in out) < 120


def test_documents_of_a_hot_owner_are_divided(spark):
    details = spark.range(300).selectExpr("IF(id < 200, 1, id) AS k", "id AS item", "id % 2 AS flag")
    owners = spark.createDataFrame([(1, "hot"), (205, "one"), (999, "none")], ["k", "name"])
    out = aggregates.nested_documents(owners, details, "k", ["item", "flag"], "items", max_items=30).collect()
    hot = [r for r in out if r["k"] == 1]
    assert len(hot) > 3 and sorted(i["item"] for r in hot for i in r["items"]) == list(range(200))
    assert [len(r["items"]) for r in out if r["k"] == 205] == [1]
    assert [(r["part"], r["items"]) for r in out if r["k"] == 999] == [(0, None)]


def _hot_sides(spark):
    """Detail rows with a hot key, copies and NULLs; names with some keys more and some fewer."""
    rng = random.Random(11)
    data = [(0 if rng.random() < 0.4 else rng.choice([None, *range(1, 30)]), i // 2) for i in range(400)]
    details = spark.createDataFrame(data, "k int, item int")
    names = [(k, f"n{k}") for k in range(0, 35) if k != 7] + [(None, "none"), (0, "twice")]
    return details, spark.createDataFrame(names, "k int, name string")


@pytest.mark.parametrize("how", ["inner", "left", "right", "left_semi"])
@pytest.mark.parametrize("rows_per_slot", [3, 40, 1000])
def test_split_join_equals_plain_join(spark, how, rows_per_slot):
    details, names = _hot_sides(spark)
    split = split_join(details, names, ["k"], ["item"], how, rows_per_slot=rows_per_slot)
    plain = details.join(names, ["k"], how)
    assert split.columns == plain.columns and rows(split) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left", "right"])
@pytest.mark.parametrize("rows_per_slot", [3, 40])
def test_hot_rows_on_the_right(spark, how, rows_per_slot):
    details, names = _hot_sides(spark)
    split = joins.join_using(names, details, "k", how, ["item"], rows_per_slot=rows_per_slot)
    plain = joins.join_using(names, details, "k", how)
    assert split.columns == plain.columns and rows(split) == rows(plain)
    renamed = details.withColumnRenamed("k", "k2")
    split = joins.join_on(names, renamed, "k", "k2", how, ["item"], rows_per_slot=rows_per_slot)
    plain = joins.join_on(names, renamed, "k", "k2", how)
    assert split.columns == plain.columns and rows(split) == rows(plain)


def test_split_join_on_two_keys(spark):
    data = [(i % 2, "x" if i % 3 else "y", i) for i in range(120)]
    left = spark.createDataFrame(data, ["a", "b", "item"])
    right = spark.createDataFrame([(0, "x", "p"), (1, "y", "q")], ["a", "b", "v"])
    split = split_join(left, right, ["a", "b"], ["item"], "left", rows_per_slot=5)
    assert rows(split) == rows(left.join(right, ["a", "b"], "left"))


def test_split_join_on_times_and_bytes(spark):
    data = [(dt.datetime(2024, 1, 1, 0, 0, 0, i % 3), b"k", i) for i in range(90)]
    details = spark.createDataFrame(data, "t timestamp_ntz, b binary, item int")
    owners = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, i), b"k") for i in range(9)], "t timestamp_ntz, b binary")
    for keys in (["t"], ["b"], ["t", "b"]):
        first, second = owners.select(*keys), details.select(*keys, "item")
        split = split_join(first, second, keys, ["item"], "left", "right", rows_per_slot=7)
        assert rows(split) == rows(first.join(second, keys, "left"))


def test_split_join_spreads_the_hot_key(spark):
    left = spark.range(1000).selectExpr("IF(id < 400, 0, id) AS k", "id AS item")
    slots = Slots(left, ["k"], rows_per_slot=50)
    assert [tuple(r) for r in slots.table.collect()] == [(0, 8)]
    scattered = slots.scatter(left, ["k"], [F.col("item")]).filter("k = 0")
    assert scattered.select("_slot").distinct().count() == 8
    with pytest.raises(ValueError):
        split_join(left, left, ["k"], ["item"], "full")
    with pytest.raises(ValueError):
        split_join(left, left, ["k"], ["item"], "left_semi", "right")


def test_only_the_most_frequent_keys_can_be_hot(spark):
    left = spark.range(1000).selectExpr("id % 10 AS k", "id AS item")
    assert len(Slots(left, ["k"], rows_per_slot=5, max_hot=3).table.collect()) == 3


def test_top_n_and_other(spark):
    df = spark.createDataFrame([(g,) for g in "a" * 5 + "b" * 3 + "c" * 2 + "d" + "e"], ["g"])
    out = rows(aggregates.top_n_other_share(df, "g", 2))
    assert out == [("Other", 4, 33.3), ("a", 5, 41.7), ("b", 3, 25.0)]
    assert ("Other" in [r[0] for r in rows(aggregates.top_n_other_share(df, "g", 10))]) is False


def test_a_category_named_other_stays_apart(spark):
    df = spark.createDataFrame([(g,) for g in ["Other"] * 5 + ["x"] * 3 + ["y"] + [None] * 2], ["g"])
    assert sorted(r[1] for r in rows(aggregates.top_n_other_share(df, "g", 1))) == [5, 6]
    top3 = aggregates.top_n_other_share(df, "g", 3)
    assert sorted((str(r[0]), r[1]) for r in top3.collect()) == [("None", 2), ("Other", 1), ("Other", 5), ("x", 3)]


def test_top_groups_over_time(spark):
    df = spark.createDataFrame([(2000, "a"), (2001, "a"), (2001, "b"), (2001, "b"), (2002, "c")], ["y", "g"])
    assert rows(aggregates.top_groups_over_time(df, "y", "g", 2)) == [(2000, "a", 1), (2001, "a", 1), (2001, "b", 2)]


def test_pivot_counts_every_row(spark):
    df = spark.createDataFrame([(2000, "a"), (2001, "b"), (2001, "b"), (2001, "zz"), (2002, None)], ["y", "g"])
    out = aggregates.pivot_counts(df, "y", "g", ["a", "b"])
    assert out.columns == ["y", "a", "b", "other"]
    assert rows(out) == [(2000, 1, 0, 0), (2001, 0, 2, 1), (2002, 0, 0, 1)]
    top = aggregates.pivot_top(df.filter("g is not null"), "y", "g", 1)
    assert top.columns == ["y", "b", "other"] and rows(top) == [(2000, 0, 1), (2001, 2, 1)]
    with pytest.raises(ValueError):
        aggregates.pivot_counts(df, "y", "g", ["a", "other"])


def test_distinct_counts_take_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (3, None)], "a int, b int")
    assert rows(aggregates.distinct_counts(df, ["a", "b"])) == [(2, 2, 3)]


def test_sorting(spark):
    df = spark.createDataFrame([("A", 7.2), ("B", 8.1), ("C", 6.9), ("D", None), ("E", 8.1)], ["t", "r"])
    assert [r[0] for r in ranking.sort_rows(df, [F.desc("r")], ["t"]).collect()] == ["B", "E", "A", "C", "D"]
    assert [r[0] for r in ranking.top_k(df, [F.desc("r")], ["t"], 2).collect()] == ["B", "E"]


def test_having_top_k(spark):
    df = spark.createDataFrame([("x", 9.0)] * 3 + [("y", 8.0)] * 4 + [("z", 10.0)], ["d", "r"])
    aggs = [F.avg("r").alias("avg"), F.count("*").alias("n")]
    out = ranking.having_top_k(df, "d", aggs, "n >= 3", [F.desc("avg")], 1)
    assert rows(out) == [("x", 9.0, 3)]


TYPES = [
    ("int", "double"), ("int", "bigint"), ("date", "timestamp"), ("decimal(10,2)", "decimal(12,4)"), ("string", "string"),
    ("double", "double"), ("int", "string"), ("float", "double"),
]


@pytest.mark.parametrize("kinds", TYPES)
@pytest.mark.parametrize("n_keys", [1, 2])
def test_split_join_compares_keys_as_a_join_does(spark, kinds, n_keys):
    def typed(number, kind):
        base = f"date'2024-01-01' + int({number})" if kind in ("date", "timestamp") else number
        return f"cast({base} as {kind})"

    keys = ["k", "j"][:n_keys]
    left = spark.range(400).selectExpr("id as item", f"{typed('id % 4', kinds[0])} as k", f"{typed('id % 2', kinds[0])} as j")
    left = left.unionAll(left.selectExpr("item + 1000", "null", "j"))
    right = spark.range(6).selectExpr(f"{typed('id', kinds[1])} as k", f"{typed('id % 2', kinds[1])} as j", "id as name")
    if kinds[0] == "double":
        left = left.unionAll(left.selectExpr("item + 2000", "if(item % 2 = 0, -0.0D, double('NaN'))", "-j"))
        right = right.unionAll(right.selectExpr("double('NaN')", "j", "name + 10"))
    # As text, since NaN is not equal to itself.
    texts = lambda df: [str(r) for r in rows(df)]
    for how in ("inner", "left", "right", "left_semi"):
        plain = left.join(right, keys, how)
        split = split_join(left, right, keys, ["item"], how, rows_per_slot=7)
        assert split.columns == plain.columns and texts(split) == texts(plain), how
        if how != "left_semi":
            turned = split_join(right, left, keys, ["item"], how, "right", rows_per_slot=7)
            assert texts(turned) == texts(right.join(left, keys, how)), how


def test_null_profile_of_dotted_names(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "`a.b` int, c int")
    assert rows(quality.null_profile(df)) == [("a.b", 1), ("c", 2)]
