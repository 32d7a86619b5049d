"""Joins and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import joins, unions
from millrace.plans.registry import query
from millrace.tables import table


# Columns that tell the lines of one order apart.
LINE_SPREAD = ["l_partkey", "l_linenumber"]


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"), "o_orderstatus"
    )


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_partkey"
    )


def _late_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders still open, so that the other side keeps rows without a partner."""
    return _orders(spark, sf).filter(F.col("o_orderstatus") == "O")


@query("""
    SELECT o_custkey AS custkey, o_orderkey AS orderkey, o_orderstatus, c_name, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment"
    )
    return joins.join_using(_orders(spark, sf), customers, "custkey")


@query("""
    SELECT o_orderkey AS orderkey, l_orderkey, l_linenumber, l_partkey
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def join_left_expr(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf).select("orderkey")
    lines = _lines(spark, sf).withColumnRenamed("orderkey", "l_orderkey")
    return joins.join_on(orders, lines, "orderkey", "l_orderkey", "left", LINE_SPREAD)


@query("""
    SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus, l_linenumber, l_partkey
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def join_left_using(spark: SparkSession, sf: str) -> DataFrame:
    return joins.join_using(_orders(spark, sf), _lines(spark, sf), "orderkey", "left", LINE_SPREAD)


@query("""
    SELECT o_orderkey, o_custkey AS custkey, o_orderstatus, l_orderkey AS orderkey, l_linenumber,
           l_partkey
    FROM (SELECT * FROM orders WHERE o_orderstatus = 'O') RIGHT JOIN lineitem
      ON o_orderkey = l_orderkey
""")
def join_right_expr(spark: SparkSession, sf: str) -> DataFrame:
    orders = _late_orders(spark, sf).withColumnRenamed("orderkey", "o_orderkey")
    return joins.join_on(orders, _lines(spark, sf), "o_orderkey", "orderkey", "right")


@query("""
    SELECT l_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus, l_linenumber, l_partkey
    FROM (SELECT * FROM orders WHERE o_orderstatus = 'O') RIGHT JOIN lineitem
      ON o_orderkey = l_orderkey
""")
def join_right_using(spark: SparkSession, sf: str) -> DataFrame:
    return joins.join_using(_late_orders(spark, sf), _lines(spark, sf), "orderkey", "right")


def rentals(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as rentals of a supplier's car at an agency of the customer's nation: keys inside JSON
    text, names inside the JSON text of three dimensions."""
    customer = table(spark, sf, "customer")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    nations = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    keys = F.struct(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("car_id"),
        F.col("c_nationkey").alias("agency_id"),
    )
    fact = lines.join(orders, "l_orderkey").join(nations, "o_custkey").select(
        (F.col("l_orderkey").cast("bigint") * 10 + F.col("l_linenumber")).alias("rental_id"),
        F.to_json(keys).alias("rental_info"),
    )
    customers = customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.to_json(F.struct(F.col("c_name").alias("customer_name"))).alias("customer_info"),
    )
    cars = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("car_id"),
        F.to_json(F.struct(F.col("s_name").alias("car_name"))).alias("car_info"),
    )
    agencies = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("agency_id"),
        F.to_json(F.struct(F.col("n_name").alias("agency_name"))).alias("agency_info"),
    )
    return joins.star_join(
        fact,
        "rental_info",
        ["rental_id"],
        [
            (cars, "car_id", "car_info", "car_name"),
            (agencies, "agency_id", "agency_info", "agency_name"),
            (customers, "customer_id", "customer_info", "customer_name"),
        ],
    )


RENTALS = """
    SELECT CAST(l_orderkey AS BIGINT) * 10 + l_linenumber AS rental_id, s_name AS car_name, n_name AS agency_name,
           c_name AS customer_name
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = c_nationkey
"""


@query(RENTALS)
def star_join_json_keys(spark: SparkSession, sf: str) -> DataFrame:
    return rentals(spark, sf)


def _accounts(spark: SparkSession, sf: str, name: str, prefix: str) -> DataFrame:
    columns = {"id": f"{prefix}_{'custkey' if prefix == 'c' else 'suppkey'}"}
    columns |= {"name": f"{prefix}_name", "nation": f"{prefix}_nationkey"}
    return table(spark, sf, name).select(*[F.col(c).alias(n) for n, c in columns.items()])


@query("""
    SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier
""")
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    return unions.union_all(
        _accounts(spark, sf, "customer", "c"), _accounts(spark, sf, "supplier", "s")
    )


@query("SELECT o_orderkey AS orderkey FROM orders UNION SELECT l_orderkey FROM lineitem")
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return unions.union_distinct(
        _orders(spark, sf).select("orderkey"), _lines(spark, sf).select("orderkey")
    )


@query("""
    SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier
""")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = _accounts(spark, sf, "supplier", "s").select("nation", "name", "id")
    return unions.union_by_name(_accounts(spark, sf, "customer", "c"), suppliers)


@query("""
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
""")
def union_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = _accounts(spark, sf, "supplier", "s").select("id", "name")
    return unions.union_by_name(customers, suppliers, fill_missing=True)
