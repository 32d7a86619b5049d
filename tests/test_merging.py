"""Stores that are merged into by key."""

import pytest

from conftest import rows
from millrace.scratch import scratch_path
from millrace.sinks import merging


def test_nodes_merge_by_key(spark):
    path = scratch_path(spark, "nodes")
    assert merging.read_merged(spark, path) is None
    first = spark.createDataFrame([(1, "a", 10), (2, "b", None), (2, "a", 5), (None, "x", 1)], "id int, name string, age int")
    assert [merging.merge_nodes(spark, first, "id", path) for _ in range(2)] == [1, 2]
    once = rows(merging.read_merged(spark, path))
    assert once == [(1, "a", 10), (2, "a", 5), (None, "x", 1)]
    second = spark.createDataFrame([(2, None, "new"), (3, "c", "new"), (None, "y", "new")], "id int, name string, tag string")
    for _ in range(2):
        merging.merge_nodes(spark, second, "id", path)
        assert rows(merging.read_merged(spark, path)) == [
            (1, "a", 10, None), (2, None, 5, "new"), (3, "c", None, "new"), (None, "y", 1, "new"),
        ]


def test_relationships_need_stored_nodes(spark):
    nodes, path = scratch_path(spark, "nodes"), scratch_path(spark, "edges")
    edges = spark.createDataFrame([(1, 2, 7), (1, 2, 3), (2, 1, 1), (1, 9, 1)], "src int, dst int, w int")
    with pytest.raises(ValueError, match="no nodes"):
        merging.merge_relationships(spark, edges, nodes, path)
    merging.merge_nodes(spark, spark.createDataFrame([(1,), (2,)], "id int"), "id", nodes)
    for _ in range(2):
        merging.merge_relationships(spark, edges, nodes, path)
        assert rows(merging.read_merged(spark, path)) == [(1, 2, 3), (2, 1, 1)]
    merging.merge_relationships(spark, spark.createDataFrame([(1, 2, 8)], "src int, dst int, w int"), nodes, path)
    assert rows(merging.read_merged(spark, path)) == [(1, 2, 8), (2, 1, 1)]


def test_an_unfinished_version_is_not_read(spark):
    path = scratch_path(spark, "nodes")
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    merging.merge_nodes(spark, df, "id", path)
    spark.createDataFrame([(5, "broken")], "id int, name string").write.parquet(f"{path}/versions/left-behind")
    assert rows(merging.read_merged(spark, path)) == [(1, "a")]
    assert merging.merge_nodes(spark, df, "id", path) == 2


def test_empty_tables(spark):
    path = scratch_path(spark, "nodes")
    none = spark.createDataFrame([], "id int, name string")
    merging.merge_nodes(spark, none, "id", path)
    merging.merge_nodes(spark, spark.createDataFrame([(1, "a")], "id int, name string"), "id", path)
    merging.merge_nodes(spark, none, "id", path)
    assert rows(merging.read_merged(spark, path)) == [(1, "a")]
