"""Schemas, projections, filters, buckets and null handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.numbers import bucket, in_bucket
from millrace.operators import quality, ranking
from millrace.plans.registry import query
from millrace.schema import conform, declare_schema
from millrace.tables import table


@query("""
    SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_totalprice, o_orderpriority
    FROM orders
""")
def schema_projection(spark: SparkSession, sf: str) -> DataFrame:
    schema = declare_schema(
        [
            ("o_orderkey", "long"),
            ("o_custkey", "int"),
            ("o_totalprice", "double"),
            ("o_orderpriority", "string"),
        ]
    )
    return conform(table(spark, sf, "orders"), schema)


@query("""
    SELECT c_custkey, c_name AS full_name, c_mktsegment AS segment,
           CAST(c_nationkey AS VARCHAR) AS nation
    FROM customer
""")
def struct_build(spark: SparkSession, sf: str) -> DataFrame:
    schema = declare_schema(
        [
            ("c_custkey", "long"),
            ("profile", "struct", [("full_name", "string"), ("home", "struct", [("segment", "string"), ("nation", "string")])]),
        ]
    )
    home = F.struct("c_mktsegment", "c_nationkey")
    nested = table(spark, sf, "customer").select("c_custkey", F.struct("c_name", home).alias("profile"))
    return conform(nested, schema).select("c_custkey", "profile.full_name", "profile.home.*")


@query("SELECT p_partkey AS part_id, p_name AS part_name, p_brand AS brand FROM part")
def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("part_id"),
        F.col("p_name").alias("part_name"),
        F.col("p_brand").alias("brand"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice * 0.16::DOUBLE AS paid_tax,
           l_extendedprice * (1 - l_discount) AS effective_value, 'IN' AS country_code
    FROM lineitem
""")
def derived_columns(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (price * 0.16).alias("paid_tax"),
        (price * (1 - F.col("l_discount"))).alias("effective_value"),
        F.lit("IN").alias("country_code"),
    )


@query("SELECT event_id, event_type, value FROM events WHERE value > 70")
def filter_compare(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events").filter(F.col("value") > 70).select("event_id", "event_type", "value")
    )


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_acctbal <= 5000")
def filter_range(spark: SparkSession, sf: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return (
        table(spark, sf, "customer")
        .filter((balance > 0) & (balance <= 5000))
        .select("c_custkey", "c_acctbal")
    )


@query("SELECT p_partkey, p_size FROM part WHERE p_size % 5 = 0")
def filter_multiples(spark: SparkSession, sf: str) -> DataFrame:
    """Parts whose size is a multiple of five: the predicate is the operator."""
    return table(spark, sf, "part").filter(F.col("p_size") % 5 == 0).select("p_partkey", "p_size")


@query("""
    SELECT l_orderkey, l_linenumber, l_discount,
           CASE WHEN l_discount = 0.1 THEN 'Great Deal' ELSE 'No Deal' END AS discount_level
    FROM lineitem
""")
def case_two_way(spark: SparkSession, sf: str) -> DataFrame:
    level = bucket([(F.col("l_discount") == 0.1, "Great Deal")], "No Deal")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_discount", level.alias("discount_level")
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, 'LATE' AS delivery_sla
    FROM lineitem WHERE l_quantity > 20
    ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey
""")
def sla_bucket_late(spark: SparkSession, sf: str) -> DataFrame:
    minutes = F.col("l_quantity")
    rules = [
        (minutes <= 15, "FAST"),
        ((minutes > 15) & (minutes <= 20), "ON_TIME"),
        (minutes > 20, "LATE"),
    ]
    late = (
        table(spark, sf, "lineitem")
        .filter(in_bucket(rules, "LATE"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", bucket(rules).alias("delivery_sla"))
    )
    return ranking.sort_rows(
        late, [F.desc("l_quantity")], ["l_orderkey", "l_linenumber", "l_partkey"]
    )


def _orders_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with some values missing; the input tables hold no nulls."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.when(F.col("o_totalprice") >= 1000, F.col("o_totalprice")).alias("o_totalprice"),
    )


GAPS = """
    WITH gaps AS (
        SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
               nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
               CASE WHEN o_totalprice >= 1000 THEN o_totalprice END AS o_totalprice
        FROM orders)
"""


@query(GAPS + """
    SELECT count(*) - count(o_orderkey) AS o_orderkey, count(*) - count(o_orderstatus) AS o_orderstatus,
           count(*) - count(o_orderpriority) AS o_orderpriority,
           count(*) - count(o_totalprice) AS o_totalprice
    FROM gaps
""")
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.count_nulls(_orders_with_gaps(spark, sf))


@query(GAPS + """
    SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS nulls FROM gaps
    UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM gaps
    UNION ALL SELECT 'o_orderpriority', count(*) - count(o_orderpriority) FROM gaps
    UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM gaps
""")
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_profile(_orders_with_gaps(spark, sf))


@query(GAPS + """
    SELECT * FROM gaps
    WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL
""")
def drop_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return quality.drop_nulls(_orders_with_gaps(spark, sf))


@query(GAPS + """
    SELECT o_orderkey, coalesce(o_orderstatus, 'unknown') AS o_orderstatus,
           coalesce(o_orderpriority, 'unknown') AS o_orderpriority,
           coalesce(o_totalprice, 0.0) AS o_totalprice
    FROM gaps
""")
def fill_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return quality.fill_nulls(
        _orders_with_gaps(spark, sf),
        {"o_orderstatus": "unknown", "o_orderpriority": "unknown", "o_totalprice": 0.0},
    )


@query(GAPS + "SELECT o_orderkey, coalesce(o_orderstatus, '0') AS o_orderstatus FROM gaps")
def fill_nulls_cast(spark: SparkSession, sf: str) -> DataFrame:
    rows = _orders_with_gaps(spark, sf).select("o_orderkey", "o_orderstatus")
    return quality.fill_nulls(rows, {"o_orderstatus": 0})
