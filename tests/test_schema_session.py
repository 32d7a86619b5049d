import datetime as dt

import pytest
from pyspark.sql import types as T

from conftest import rows
from millrace import scratch
from millrace.schema import TYPE_NAMES, conform, declare_schema, describe_columns
from millrace.session import build_session


def test_flat_and_nested_schema():
    schema = declare_schema(
        [("id", "int"), ("tags", "array_string"), ("address", "struct", [("city", "string"), ("geo", "struct", [("lat", "double")])])]
    )
    assert schema.simpleString() == (
        "struct<id:int,tags:array<string>,address:struct<city:string,geo:struct<lat:double>>>"
    )
    assert all(f.nullable for f in schema.fields)


def test_every_type_name_builds():
    schema = declare_schema([(f"c{i}", n) for i, n in enumerate(TYPE_NAMES)])
    assert len(schema) == 12


@pytest.mark.parametrize("column", [("a", "struct"), ("a", "struct", "city"), ("a", "decimal"), ("a", "map")])
def test_bad_declarations(column):
    with pytest.raises(ValueError):
        declare_schema([column])


def test_tables_from_tuples(spark):
    data = [(1, "x"), (2, None)]
    declared = declare_schema([("id", "int"), ("name", "string")])
    assert describe_columns(spark.createDataFrame(data, declared)) == [("id", "int"), ("name", "string")]
    by_hand = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    assert declared == by_hand
    assert spark.createDataFrame(data, ["id", "name"]).columns == ["id", "name"]
    assert spark.createDataFrame(data).columns == ["_1", "_2"]


def test_conform(spark):
    df = spark.createDataFrame([("7", "2024-01-05", 1)], ["n", "day", "extra"])
    assert rows(conform(df, declare_schema([("day", "date"), ("n", "long")]))) == [(dt.date(2024, 1, 5), 7)]


def test_session_helper_reuses_and_configures(spark):
    again = build_session("tests", shuffle_partitions=8)
    assert again.sparkContext.applicationId == spark.sparkContext.applicationId
    assert again.conf.get("spark.sql.shuffle.partitions") == "8"
    assert again.conf.get("spark.sql.adaptive.enabled") == "true"


def test_session_without_shuffle_override_keeps_the_cluster_value(spark):
    build_session("tests", packages=None, jars=None)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_scratch_paths_are_new_and_under_the_shared_folder(spark):
    first, second = scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "x")
    root = scratch.scratch_root(spark)
    assert first != second and first.startswith(root + "/")
    setting = spark.conf.get(scratch.SETTING, None)
    assert setting is None or root == setting.rstrip("/")


def test_materialize_keeps_rows_and_cuts_the_plan(spark):
    df = spark.range(100).selectExpr("id % 3 AS k").groupBy("k").count()
    kept = scratch.materialize(df, "kept")
    assert rows(kept) == rows(df)
    assert "Aggregate" not in kept._jdf.queryExecution().toString()
