import json

import pytest

from conftest import rows
from millrace.operators.aggregates import nested_documents
from millrace.schema import declare_schema
from millrace.scratch import scratch_path
from millrace.sinks import stores
from millrace.sinks.files import write_csv, write_partitioned
from millrace.sources.files import map_text, read_csv, read_files
from millrace.sources.jdbc import Jdbc, split_options
from millrace.plans.scalars import strip_tags


def test_csv_directory_with_header(spark):
    df = spark.range(50).selectExpr("CAST(id AS INT) AS id", "concat('n,', id) AS name", "IF(id = 3, NULL, id / 4) AS x")
    path = scratch_path(spark, "csv")
    write_csv(df.repartition(4), path, header="true")
    write_csv(df.repartition(4), path, header="true")
    back = read_csv(spark, path, declare_schema([("id", "int"), ("name", "string"), ("x", "double")]))
    assert rows(back) == rows(df)


def test_bad_cell_becomes_null(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("id,x",), ("1,abc",), ("2,5",)], ["v"]).coalesce(1).write.text(path)
    assert rows(read_csv(spark, path, declare_schema([("id", "int"), ("x", "int")]))) == [(1, None), (2, 5)]


def test_two_colons(spark):
    path = scratch_path(spark, "ratings")
    spark.createDataFrame([("1::31::4::978300019",), ("2::7::5::978300055",)], ["v"]).write.text(path)
    schema = declare_schema([(n, "int") for n in ("user_id", "movie_id", "rating", "timestamp")])
    assert rows(read_csv(spark, path, schema, header=False, delimiter="::")) == [(1, 31, 4, 978300019), (2, 7, 5, 978300055)]


def test_partition_directories_prune(spark):
    df = spark.range(90).selectExpr("id", "concat('agency ', id % 3) AS agency")
    path = scratch_path(spark, "parts")
    write_partitioned(df, path, ["agency"])
    north = spark.read.parquet(path).filter("agency = 'agency 1'")
    assert north.count() == 30 and "PartitionFilters: [isnotnull(agency" in north._jdf.queryExecution().toString()
    assert rows(spark.read.parquet(path)) == rows(df)


def test_one_row_per_file(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"p{i}.html").write_text(f"<p>page <b>{i}</b></p>")
    (tmp_path / "notes.md").write_text("x")
    files = read_files(spark, str(tmp_path), "*.html").selectExpr("path", "CAST(content AS STRING) AS html")
    assert [r["text"] for r in map_text(files, "path", "html", strip_tags).orderBy("path").collect()] == ["page 0", "page 1", "page 2"]


def test_python_function_keeps_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, t string")
    assert rows(map_text(df, "id", "t", str.upper)) == [(1, "A"), (2, None)]


def test_document_sink(spark):
    users = spark.createDataFrame([("u1", "A"), ("u2", "B")], ["user_id", "name"])
    ratings = spark.createDataFrame([("u1", "Zelda", 5.0), ("u1", "Halo", 4.0)], ["user_id", "game", "score"])
    path = scratch_path(spark, "docs")
    stores.write_documents(nested_documents(users, ratings, "user_id", ["game", "score"], "ratings"), {"path": path}, fmt="json")
    docs = sorted((json.loads(r[0]) for r in spark.read.text(path).collect()), key=lambda d: d["user_id"])
    assert docs == [
        {"user_id": "u1", "name": "A", "part": 0, "ratings": [{"game": "Halo", "score": 4.0}, {"game": "Zelda", "score": 5.0}]},
        {"user_id": "u2", "name": "B", "part": 0},
    ]


def test_graph_sinks(spark):
    nodes = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "B")], ["id", "name"])
    edges = spark.createDataFrame([("a", "b", "follows"), ("a", "x", "follows")], ["src", "dst", "relationship"])
    path = scratch_path(spark, "graph")
    stores.write_nodes(nodes, "id", {"path": f"{path}/nodes"}, fmt="parquet")
    stores.write_relationships(edges, nodes, {"path": f"{path}/edges"}, fmt="parquet")
    assert rows(spark.read.parquet(f"{path}/nodes")) == [("a", "A"), ("b", "B")]
    assert rows(spark.read.parquet(f"{path}/edges")) == [("a", "b", "follows")]


def test_connector_options():
    db = Jdbc("jdbc:x://h/db", "org.x.Driver", user="u", password="p", extra={"ssl": "true"})
    assert db.options("t") == {
        "url": "jdbc:x://h/db", "driver": "org.x.Driver", "dbtable": "t", "ssl": "true", "user": "u", "password": "p"
    }
    assert stores.jdbc_options(db, "t", 4, 100)["numPartitions"] == "4"
    assert split_options("id", 0, 100, 4) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"
    }
    with pytest.raises(ValueError):
        split_options("id", 5, 5, 4)
    assert stores.document_options("m://h", "d", "c") == {"connection.uri": "m://h", "database": "d", "collection": "c"}
    assert stores.node_options("n://h", "User", "id") == {"url": "n://h", "labels": ":User", "node.keys": "id"}
    options = stores.relationship_options("n://h", "FOLLOWS", "User", "id")
    assert options["relationship.source.save.mode"] == options["relationship.target.save.mode"] == "match"
    assert options["relationship.source.node.keys"] == "src:id" and options["relationship.target.node.keys"] == "dst:id"
