"""Graph operators over the parts: an edge leads from the part on one line of an order to the part on
the next line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.graph import Graph
from millrace.plans.registry import query
from millrace.tables import table

ROUNDS = 10
LABEL_ROUNDS = 5


def part_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct successions of two parts.

    Each line offers its part as the start of one step and the end of the step before, so one
    grouping by (order, step) pairs them; an order of any length is spread by its steps. The lowest
    part stands for a line number that an order has twice.
    """
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    none = F.lit(None).cast("bigint")
    start = F.struct(line.alias("step"), part.alias("src"), none.alias("dst"))
    end = F.struct((line - 1).alias("step"), none.alias("src"), part.alias("dst"))
    steps = table(spark, sf, "lineitem").select("l_orderkey", F.inline(F.array(start, end)))
    return (
        steps.groupBy("l_orderkey", "step")
        .agg(F.min("src").alias("src"), F.min("dst").alias("dst"))
        .filter(F.col("src") != F.col("dst"))
        .select("src", "dst")
        .distinct()
    )


def part_graph(spark: SparkSession, sf: str) -> Graph:
    vertices = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return Graph(vertices, part_edges(spark, sf))


EDGES = """
    WITH slots AS MATERIALIZED (
        SELECT l_orderkey AS o, l_linenumber AS i, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2),
    edges AS MATERIALIZED (
        SELECT DISTINCT a.p AS src, b.p AS dst FROM slots a JOIN slots b ON a.o = b.o AND b.i = a.i + 1
        WHERE a.p <> b.p)
"""


def _pagerank_sql() -> str:
    steps = [
        ", outs AS MATERIALIZED (SELECT src, count(*) AS n FROM edges GROUP BY src)",
        ", r0 AS MATERIALIZED (SELECT p_partkey AS id, 1.0::DOUBLE AS r FROM part)",
    ]
    for k in range(ROUNDS):
        steps.append(f"""
    , r{k + 1} AS MATERIALIZED (
        SELECT part.p_partkey AS id, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(s.total, 0) AS r
        FROM part LEFT JOIN (
            SELECT edges.dst, sum(r{k}.r / outs.n) AS total
            FROM edges JOIN r{k} ON r{k}.id = edges.src JOIN outs ON outs.src = edges.src
            GROUP BY edges.dst) s ON s.dst = part.p_partkey)""")
    last = f"r{ROUNDS}"
    return EDGES + "".join(steps) + f"""
    SELECT id, p_name AS name,
           round({last}.r * (SELECT count(*) FROM part) / (SELECT sum(r) FROM {last}), 6) AS pagerank
    FROM {last} JOIN part ON p_partkey = id"""


@query(_pagerank_sql())
def graph_pagerank(spark: SparkSession, sf: str) -> DataFrame:
    ranks = part_graph(spark, sf).pagerank(rounds=ROUNDS)
    ranks = ranks.select("id", "name", F.round("pagerank", 6).alias("pagerank"))
    return ranks.orderBy(F.desc("pagerank"), "id")


def _label_sql() -> str:
    steps = [
        ", both_ways AS MATERIALIZED (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges)",
        ", l0 AS MATERIALIZED (SELECT p_partkey AS id, p_partkey AS label FROM part)",
    ]
    for k in range(LABEL_ROUNDS):
        steps.append(f"""
    , l{k + 1} AS MATERIALIZED (
        SELECT part.p_partkey AS id, coalesce(w.label, part.p_partkey) AS label
        FROM part LEFT JOIN (
            SELECT dst, label FROM (
                SELECT b.dst, l.label, row_number() OVER (PARTITION BY b.dst ORDER BY count(*) DESC, l.label) AS place
                FROM both_ways b JOIN l{k} l ON l.id = b.src GROUP BY b.dst, l.label)
            WHERE place = 1) w ON w.dst = part.p_partkey)""")
    return EDGES + "".join(steps) + f"""
    SELECT id, p_name AS name, label FROM l{LABEL_ROUNDS} JOIN part ON p_partkey = id"""


@query(_label_sql())
def graph_label_propagation(spark: SparkSession, sf: str) -> DataFrame:
    return part_graph(spark, sf).label_propagation(rounds=LABEL_ROUNDS)


@query(EDGES + """
    , pairs AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges)
    , triangles AS (
        SELECT x.a AS u, x.b AS v, y.b AS w
        FROM pairs x JOIN pairs y ON y.a = x.b JOIN pairs z ON z.a = x.a AND z.b = y.b)
    , corners AS (SELECT u AS id FROM triangles UNION ALL SELECT v FROM triangles UNION ALL SELECT w FROM triangles)
    , counts AS (SELECT id, count(*) AS n FROM corners GROUP BY id)
    SELECT p_partkey AS id, p_name AS name, coalesce(n, 0) AS triangles
    FROM part LEFT JOIN counts ON id = p_partkey
""")
def graph_triangles(spark: SparkSession, sf: str) -> DataFrame:
    return part_graph(spark, sf).triangle_counts()


@query(EDGES + """
    SELECT dst AS id, count(*) AS in_degree, p_name AS name
    FROM edges JOIN part ON p_partkey = dst GROUP BY dst, p_name
""")
def graph_in_degrees(spark: SparkSession, sf: str) -> DataFrame:
    return part_graph(spark, sf).in_degrees()


@query(EDGES + """
    SELECT src AS id, count(*) AS out_degree, p_name AS name
    FROM edges JOIN part ON p_partkey = src GROUP BY src, p_name
""")
def graph_out_degrees(spark: SparkSession, sf: str) -> DataFrame:
    return part_graph(spark, sf).out_degrees()
