"""Sinks and sources: each query writes to a fresh shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.aggregates import nested_documents as nest
from millrace.plans.graphs import EDGES, part_edges
from millrace.plans.joining import RENTALS, rentals
from millrace.plans.registry import query
from millrace.schema import declare_schema
from millrace.scratch import materialize, scratch_path
from millrace.sinks import merging
from millrace.sinks.files import write_csv, write_partitioned
from millrace.sinks.stores import write_documents, write_nodes, write_relationships
from millrace.sources.files import read_csv
from millrace.tables import table


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    schema = declare_schema(
        [
            ("o_orderkey", "long"),
            ("o_custkey", "long"),
            ("o_orderstatus", "string"),
            ("o_totalprice", "double"),
            ("o_orderdate", "timestamp"),
            ("o_orderpriority", "string"),
        ]
    )
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf, "orders").select(*schema.names), path, header="true")
    orders = read_csv(spark, path, schema)
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("""
    SELECT CAST(l_suppkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS movie_id,
           CAST(least(5, 1 + floor(l_quantity / 10)) AS INTEGER) AS rating,
           CAST(epoch(l_shipdate) AS INTEGER) AS "timestamp"
    FROM lineitem
""")
def csv_delimiter(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings written and read without a header, parted by two colons."""
    names = ["user_id", "movie_id", "rating", "timestamp"]
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date"))
    ratings = table(spark, sf, "lineitem").select(
        F.col("l_suppkey"),
        F.col("l_partkey"),
        F.least(F.lit(5), 1 + F.floor(F.col("l_quantity") / 10)),
        days * 86400,
    ).toDF(*names)
    path = scratch_path(spark, "ratings")
    write_csv(ratings, path, sep="::")
    schema = declare_schema([(name, "int") for name in names])
    return read_csv(spark, path, schema, header=False, delimiter="::")


@query(RENTALS)
def parquet_partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Star join written in one directory per agency."""
    path = scratch_path(spark, "rentals")
    write_partitioned(rentals(spark, sf), path, ["agency_name"])
    return spark.read.parquet(path).select("rental_id", "car_name", "agency_name", "customer_name")


@query("""
    SELECT c_custkey, c_name, 0 AS part,
           '[' || string_agg('{"orderkey":' || o_orderkey || ',"cents":' || CAST(round(o_totalprice * 100) AS BIGINT)
                      || ',"day":"' || strftime(o_orderdate, '%Y-%m-%d') || '"}', ',' ORDER BY o_orderkey) || ']' AS orders
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
""")
def nested_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their orders as nested documents, written as JSON lines."""
    owners = table(spark, sf, "customer").select("c_custkey", "c_name")
    details = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderkey").alias("orderkey"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    documents = nest(owners, details, "c_custkey", ["orderkey", "cents", "day"], "orders")
    path = scratch_path(spark, "documents")
    write_documents(documents, {"path": path}, fmt="json")
    stored = spark.read.schema(documents.schema).json(path)
    return stored.withColumn("orders", F.to_json("orders"))


@query("SELECT user_id AS id, 'user-' || user_id AS name, min(event_type) AS first_seen FROM events GROUP BY user_id")
def graph_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Users met in the event log, one node each."""
    users = table(spark, sf, "events").select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"),
        F.col("event_type").alias("first_seen"),
    )
    path = scratch_path(spark, "nodes")
    write_nodes(users, "id", {"path": path}, fmt="parquet")
    return spark.read.parquet(path)


@query("""
    WITH slots AS (
        SELECT l_orderkey AS o, l_linenumber AS i, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2),
    edges AS (
        SELECT DISTINCT a.p AS src, b.p AS dst FROM slots a JOIN slots b ON a.o = b.o AND b.i = a.i + 1
        WHERE a.p <> b.p)
    SELECT src, dst, 'followed_by' AS relationship FROM edges
    WHERE src IN (SELECT p_partkey FROM part WHERE p_size >= 20)
      AND dst IN (SELECT p_partkey FROM part WHERE p_size >= 20)
""")
def graph_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Part successions between parts of size 20 and up, the only ones that exist as nodes."""
    nodes = table(spark, sf, "part").filter("p_size >= 20").select(F.col("p_partkey").alias("id"))
    edges = part_edges(spark, sf).withColumn("relationship", F.lit("followed_by"))
    edges = materialize(edges, "edges")
    path = scratch_path(spark, "relationships")
    write_relationships(edges, nodes, {"path": path}, fmt="parquet")
    return spark.read.parquet(path)


@query("""
    SELECT p_partkey AS id, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS name, p_brand AS brand,
           CASE WHEN p_size > 25 THEN p_size END AS size
    FROM part
""")
def graph_nodes_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as nodes, written twice, then those of larger size again with other properties, twice."""
    path = scratch_path(spark, "nodes")
    part = table(spark, sf, "part")
    nodes = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    changed = part.filter("p_size > 25").select(
        F.col("p_partkey").alias("id"), F.upper("p_name").alias("name"), F.col("p_size").alias("size")
    )
    for rows in (nodes, nodes, changed, changed):
        merging.merge_nodes(spark, rows, "id", path)
    return merging.read_merged(spark, path)


@query(EDGES + """
    SELECT src, dst, CASE WHEN src % 2 = 0 THEN 'even' ELSE 'odd' END AS kind FROM edges
    JOIN part a ON a.p_partkey = src AND a.p_size > 10 JOIN part b ON b.p_partkey = dst AND b.p_size > 10
""")
def graph_relationships_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Successions of parts as relationships between stored nodes, written twice, those of even parts
    with another kind the second time."""
    nodes, path = scratch_path(spark, "nodes"), scratch_path(spark, "relationships")
    kept = table(spark, sf, "part").filter("p_size > 10").select(F.col("p_partkey").alias("id"))
    merging.merge_nodes(spark, kept, "id", nodes)
    edges = materialize(part_edges(spark, sf), "edges").withColumn("kind", F.lit("odd"))
    merging.merge_relationships(spark, edges, nodes, path)
    even = edges.filter("src % 2 = 0").withColumn("kind", F.lit("even"))
    merging.merge_relationships(spark, even, nodes, path)
    return merging.read_merged(spark, path)
