import itertools
import random
from collections import Counter

import pytest

from conftest import rows
from millrace.operators.graph import Graph, matched_relationships, unique_nodes


def build(spark, names, edges, **skew):
    vertices = spark.createDataFrame([(n, n.upper()) for n in names], ["id", "name"])
    return Graph(vertices, spark.createDataFrame(edges, ["src", "dst"]), **skew)


def random_edges(seed=5, hub="v00"):
    """A random graph with a hub, loops and copies."""
    rng = random.Random(seed)
    names = [f"v{i:02d}" for i in range(30)]
    edges = [(hub, n) for n in names[1:]] + [(n, hub) for n in names[5:20]]
    edges += [(rng.choice(names), rng.choice(names)) for _ in range(90)]
    return names + ["alone"], edges + edges[:12]


def brute_pagerank(names, edges, rounds, reset=0.15):
    out = Counter(s for s, _ in edges)
    rank = dict.fromkeys(names, 1.0)
    for _ in range(rounds):
        got = Counter()
        for s, d in edges:
            got[d] += rank[s] / out[s]
        rank = {n: reset + (1 - reset) * got[n] for n in names}
    total = sum(rank.values())
    return {n: r * len(names) / total for n, r in rank.items()}


def brute_labels(names, edges, rounds):
    label = {n: n for n in names}
    for _ in range(rounds):
        votes = {n: Counter() for n in names}
        for s, d in edges:
            votes[d][label[s]] += 1
            votes[s][label[d]] += 1
        label = {n: min(votes[n], key=lambda k: (-votes[n][k], k)) if votes[n] else label[n] for n in names}
    return label


def brute_triangles(names, edges):
    linked = {frozenset(e) for e in edges if e[0] != e[1]}
    found = Counter()
    for trio in itertools.combinations(names, 3):
        if all(frozenset(p) in linked for p in itertools.combinations(trio, 2)):
            found.update(trio)
    return {n: found[n] for n in names}


CYCLE = (["a", "b", "c"], [("a", "b"), ("b", "c"), ("c", "a")])


def test_cycle(spark):
    g = build(spark, *CYCLE)
    ranks = g.pagerank()
    assert ranks.columns == ["id", "name", "pagerank"]
    assert [round(r["pagerank"], 9) for r in ranks.collect()] == [1.0, 1.0, 1.0]
    assert {r["label"] for r in g.label_propagation().collect()} == {"a"}
    assert [r["triangles"] for r in g.triangle_counts().collect()] == [1, 1, 1]
    assert rows(g.in_degrees()) == [("a", 1, "A"), ("b", 1, "B"), ("c", 1, "C")]
    assert rows(g.out_degrees()) == [("a", 1, "A"), ("b", 1, "B"), ("c", 1, "C")]


SKEW = [{}, {"rows_per_slot": 4, "max_hot": 3}, {"rows_per_slot": 1, "max_hot": 100}]


@pytest.mark.parametrize("skew", SKEW)
def test_pagerank_equals_brute_force(spark, skew):
    names, edges = random_edges()
    ranks = {r["id"]: r["pagerank"] for r in build(spark, names, edges, **skew).pagerank(rounds=7).collect()}
    expected = brute_pagerank(names, edges, 7)
    assert ranks.keys() == expected.keys()
    assert all(abs(ranks[n] - expected[n]) < 1e-9 for n in names)
    assert abs(sum(ranks.values()) - len(names)) < 1e-9


@pytest.mark.parametrize("skew", SKEW)
def test_labels_equal_brute_force(spark, skew):
    names, edges = random_edges()
    for rounds in (1, 2):
        g = build(spark, names, edges, **skew)
        assert {r["id"]: r["label"] for r in g.label_propagation(rounds).collect()} == brute_labels(names, edges, rounds)


@pytest.mark.parametrize("skew", SKEW)
def test_triangles_equal_brute_force(spark, skew):
    names, edges = random_edges()
    g = build(spark, names, edges, **skew)
    assert {r["id"]: r["triangles"] for r in g.triangle_counts().collect()} == brute_triangles(names, edges)


def test_two_cliques_keep_two_labels(spark):
    left, right = "abcde", "vwxyz"
    edges = [*itertools.combinations(left, 2), *itertools.combinations(right, 2), ("e", "v")]
    labels = {r["id"]: r["label"] for r in build(spark, left + right, edges).label_propagation().collect()}
    assert {labels[n] for n in left} == {"a"} and {labels[n] for n in right} == {"v"}


def test_degrees_leave_out_vertices_without_any(spark):
    g = build(spark, ["a", "b", "c"], [("a", "b"), ("a", "b")])
    assert rows(g.in_degrees()) == [("b", 2, "B")] and rows(g.out_degrees()) == [("a", 2, "A")]


def test_graph_without_edges(spark):
    vertices = spark.createDataFrame([("a", "A"), ("b", "B")], ["id", "name"])
    g = Graph(vertices, spark.createDataFrame([], "src string, dst string"))
    assert [r["pagerank"] for r in g.pagerank(rounds=2).collect()] == [1.0, 1.0]
    assert [r["triangles"] for r in g.triangle_counts().collect()] == [0, 0]
    assert rows(g.label_propagation(2)) == [("a", "A", "a"), ("b", "B", "b")]


def test_columns_are_checked(spark):
    with pytest.raises(ValueError):
        Graph(spark.range(3), spark.range(3))


def test_unique_nodes_keep_the_least_row(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, None, 1)], "id int, name string, n int")
    assert rows(unique_nodes(df, "id")) == [(1, "a", 9), (2, None, 1)]
    assert unique_nodes(df.select("id"), "id").count() == 2


@pytest.mark.parametrize("skew", SKEW)
def test_relationships_need_both_nodes(spark, skew):
    nodes = spark.createDataFrame([("a",), ("b",), ("b",)], ["id"])
    edges = spark.createDataFrame([("a", "b", "f"), ("a", "c", "f"), ("c", "b", "f"), ("b", "a", "f"), ("a", "b", "f")], ["src", "dst", "relationship"])
    assert rows(matched_relationships(edges, nodes, **skew)) == [("a", "b", "f"), ("a", "b", "f"), ("b", "a", "f")]


@pytest.mark.parametrize("block", [1, 2, 7])
def test_triangles_in_blocks(spark, block):
    """Blocks of any size, hubs in many of them, give the same counts."""
    rng = random.Random(9)
    names = list(range(40))
    edges = [(rng.choice(names), rng.choice(names)) for _ in range(260)] + [(0, n) for n in names] + [(n, 1) for n in names]
    vertices = spark.createDataFrame([(n,) for n in names], ["id"])
    g = Graph(vertices, spark.createDataFrame(edges, ["src", "dst"]), rows_per_slot=15)
    assert {r["id"]: r["triangles"] for r in g.triangle_counts(block).collect()} == brute_triangles(names, edges)


def test_rounds_leave_the_session_alone(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], ["src", "dst"])
    g = Graph(spark.createDataFrame([(n,) for n in (1, 2, 3)], ["id"]), edges)
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"]
    before = [spark.conf.get(n) for n in names]
    ranks = g.pagerank(rounds=2)
    assert ranks.sparkSession is spark and [spark.conf.get(n) for n in names] == before
    assert all(abs(r["pagerank"] - 1) < 1e-9 for r in ranks.collect())
