"""Aggregates, top-k and sorting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.numbers import bucket
from millrace.operators import aggregates, ranking
from millrace.operators.totals import exact_totals
from millrace.plans.registry import query
from millrace.scratch import materialize
from millrace.streaming.wordcount import word_counts
from millrace.tables import table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _to(digits: int, df: DataFrame, column: str) -> DataFrame:
    """Without the last places of doubles, in which another engine's order of adding may differ."""
    return df.withColumn(column, F.round(column, digits))


def _orders_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n
    FROM orders GROUP BY 1 ORDER BY year
""")
def group_count(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.group_count(_orders_by_year(spark, sf), "year").orderBy("year")


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, count(*) AS n
    FROM orders GROUP BY 1, 2 ORDER BY 1, 2
""")
def group_count_multi(spark: SparkSession, sf: str) -> DataFrame:
    counts = aggregates.group_count(_orders_by_year(spark, sf), "year", "o_orderpriority")
    return counts.orderBy("year", "o_orderpriority")


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           round(avg(o_totalprice), 4) AS avg_price
    FROM orders GROUP BY 1
""")
def group_avg(spark: SparkSession, sf: str) -> DataFrame:
    by_year = exact_totals(_orders_by_year(spark, sf), ["year"], averages={"avg_price": F.col("o_totalprice")})
    return _to(4, by_year, "avg_price").orderBy("year")


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           round(sum(o_totalprice), 2) AS sum_price
    FROM orders GROUP BY 1
""")
def group_sum(spark: SparkSession, sf: str) -> DataFrame:
    by_year = exact_totals(_orders_by_year(spark, sf), ["year"], sums={"sum_price": F.col("o_totalprice")})
    return _to(2, by_year, "sum_price").orderBy("year")


@query("""
    SELECT event_type, round(avg(value), 4) AS avg_value, min(value) AS min_value
    FROM events GROUP BY event_type
""")
def group_min_avg(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value")
    found = exact_totals(
        table(spark, sf, "events"), ["event_type"], averages={"avg_value": value}, least={"min_value": value}
    )
    return _to(4, found, "avg_value")


@query("""
    SELECT o_custkey, ((2 * cents + n) // (2 * n))::DOUBLE / 100 AS avg_score, n AS num_ratings, last_rated
    FROM (SELECT o_custkey, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents, count(*) AS n,
                 max(o_orderdate) AS last_rated
          FROM orders GROUP BY o_custkey)
""")
def game_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = aggregates.rating_stats(
        table(spark, sf, "orders"), "o_custkey", "o_totalprice", "o_orderdate"
    )
    return ranking.sort_rows(stats, [F.desc("avg_score")], ["o_custkey"])


@query("""
    SELECT n_name, count(*) AS freq, round(avg(c_acctbal), 4) AS avg_balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name HAVING count(*) >= 20 ORDER BY freq DESC, n_name LIMIT 10
""")
def having_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Counted per nation key first; names are joined to the counts."""
    customer = table(spark, sf, "customer")
    per_nation = exact_totals(customer, ["c_nationkey"], averages={"avg_balance": F.col("c_acctbal")}, rows="freq")
    per_nation = _to(4, per_nation, "avg_balance").filter("freq >= 20")
    nation = table(spark, sf, "nation")
    named = per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = named.select("n_name", "freq", "avg_balance")
    return ranking.top_k(rows, [F.desc("freq")], ["n_name"], 10)


@query("""
    SELECT o_custkey, round(avg(o_totalprice), 4) AS avg_price, count(*) AS n
    FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY o_custkey HAVING count(*) >= 3
    ORDER BY avg_price DESC, o_custkey LIMIT 10
""")
def having_topk_recent(spark: SparkSession, sf: str) -> DataFrame:
    recent = table(spark, sf, "orders").filter("o_orderdate >= timestamp_ntz'1998-01-01'")
    grouped = exact_totals(recent, ["o_custkey"], averages={"avg_price": F.col("o_totalprice")}, rows="n")
    return ranking.top_k(_to(4, grouped, "avg_price").filter("n >= 3"), [F.desc("avg_price")], ["o_custkey"], 10)


@query("""
    SELECT price_bucket, count(*) AS n, round(avg(net), 4) AS avg_value
    FROM (SELECT l_extendedprice * (1 - l_discount) AS net,
                 CASE WHEN l_extendedprice * (1 - l_discount) < 20000 THEN 'LOW'
                      WHEN l_extendedprice * (1 - l_discount) <= 50000 THEN 'MEDIUM'
                      ELSE 'HIGH' END AS price_bucket
          FROM lineitem)
    GROUP BY price_bucket ORDER BY avg_value DESC
""")
def price_bucket_stats(spark: SparkSession, sf: str) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    label = bucket([(net < 20000, "LOW"), ((net >= 20000) & (net <= 50000), "MEDIUM")], "HIGH")
    stats = aggregates.bucket_stats(table(spark, sf, "lineitem"), label, "price_bucket", net)
    return _to(4, stats, "avg_value").orderBy(F.desc("avg_value"))


@query("""
    SELECT age_group, c_mktsegment, count(*) AS orders, round(avg(c_acctbal), 4) AS avg_value
    FROM (SELECT c_mktsegment, c_acctbal,
                 CASE WHEN c_acctbal < 2500 THEN 'YOUNG' WHEN c_acctbal < 4500 THEN 'ADULT'
                      ELSE 'SENIOR' END AS age_group
          FROM customer WHERE c_acctbal >= 0 AND c_acctbal <= 10000)
    GROUP BY 1, 2 ORDER BY age_group, orders DESC
""")
def band_category_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Balance in hundreds as the age: under 25, under 45, the rest; others than 0..100 are invalid."""
    value = F.col("c_acctbal")
    band = bucket([(value < 2500, "YOUNG"), ((value >= 2500) & (value < 4500), "ADULT")], "SENIOR")
    valid = table(spark, sf, "customer").filter((value >= 0) & (value <= 10000))
    banded = valid.select(band.alias("age_group"), "c_mktsegment", "c_acctbal")
    stats = exact_totals(banded, ["age_group", "c_mktsegment"], averages={"avg_value": value}, rows="orders")
    stats = _to(4, stats, "avg_value")
    return ranking.sort_rows(stats, [F.asc("age_group"), F.desc("orders")], ["c_mktsegment"])


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, count(*) AS n
    FROM orders
    WHERE o_orderpriority IN (SELECT o_orderpriority FROM orders GROUP BY 1
                              ORDER BY count(*) DESC, 1 LIMIT 3)
    GROUP BY 1, 2
""")
def top_groups_over_time(spark: SparkSession, sf: str) -> DataFrame:
    top = aggregates.top_groups_over_time(_orders_by_year(spark, sf), "year", "o_orderpriority", 3)
    return top.orderBy("year", "o_orderpriority")


@query("""
    WITH counts AS (SELECT p_brand, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS r
                    FROM part GROUP BY p_brand),
         shown AS (SELECT CASE WHEN r <= 10 THEN p_brand ELSE 'Other' END AS p_brand, CAST(sum(n) AS BIGINT) AS n
                   FROM counts GROUP BY 1),
         total AS (SELECT CAST(sum(n) AS BIGINT) AS t FROM shown)
    SELECT p_brand, n, ((2000 * n + t) // (2 * t))::DOUBLE / 10 AS percent FROM shown, total
""")
def top_n_other_share(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.top_n_other_share(table(spark, sf, "part"), "p_brand", 10)


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           count(*) FILTER (o_orderpriority = '1-URGENT') AS "1-URGENT",
           count(*) FILTER (o_orderpriority = '2-HIGH') AS "2-HIGH",
           count(*) FILTER (o_orderpriority = '3-MEDIUM') AS "3-MEDIUM",
           count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED",
           count(*) FILTER (o_orderpriority = '5-LOW') AS "5-LOW",
           count(*) FILTER (coalesce(o_orderpriority, '') NOT IN
                            ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) AS other
    FROM orders GROUP BY 1
""")
def pivot_counts(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders_by_year(spark, sf)
    return aggregates.pivot_counts(orders, "year", "o_orderpriority", PRIORITIES).orderBy("year")


@query("""
    WITH top AS (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 2),
         days AS (SELECT CAST(dayofmonth(ts) AS INTEGER) AS day, event_type FROM events),
         named AS (SELECT day, CASE WHEN event_type IN (FROM top) THEN event_type END AS t FROM days)
    SELECT day, count(t) AS n_top, count(*) - count(t) AS other FROM named GROUP BY day
""")
def pivot_top(spark: SparkSession, sf: str) -> DataFrame:
    """Events per day of the two most frequent types, summed over their columns, and of the rest."""
    days = table(spark, sf, "events").select(F.dayofmonth("ts").alias("day"), "event_type")
    wide = aggregates.pivot_top(days, "day", "event_type", 2)
    top = [F.col(f"`{c}`") for c in wide.columns if c not in ("day", "other")]
    return wide.select("day", sum(top[1:], top[0]).alias("n_top"), "other")


@query("""
    SELECT count(DISTINCT l_partkey) AS n_l_partkey, count(DISTINCT l_suppkey) AS n_l_suppkey,
           count(*) AS n_rows
    FROM lineitem
""")
def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.distinct_counts(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query("""
    SELECT l_returnflag, l_linestatus, count(DISTINCT l_partkey) AS n_distinct FROM lineitem
    GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())
""")
def distinct_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Different parts per flag and status, per flag, and in all, from the bitmaps of the finest groups."""
    groups = ["l_returnflag", "l_linestatus"]
    bitmaps = materialize(aggregates.distinct_bitmaps(table(spark, sf, "lineitem"), groups, "l_partkey"), "bitmaps")
    levels = [aggregates.merged_distinct(bitmaps, groups[:n]) for n in (2, 1, 0)]
    none = F.lit(None).cast("string")
    return reduce(DataFrame.unionByName, [level.withColumns({g: none for g in groups if g not in level.columns}) for level in levels])


@query("SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1")
def reduce_by_key(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "lineitem").select("l_partkey", F.col("l_quantity").cast("bigint").alias("quantity"))
    return aggregates.sum_by_key(pairs, "l_partkey", "quantity")


@query("""
    SELECT l_partkey, 0 AS part, count(*) AS n_values,
           string_agg(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), ',' ORDER BY l_quantity) AS quantities
    FROM lineitem GROUP BY l_partkey
""")
def values_by_key(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "lineitem").select("l_partkey", F.col("l_quantity").cast("int").alias("quantity"))
    grouped = aggregates.collect_items(pairs, ["l_partkey"], ["quantity"], "quantities")
    return grouped.select(
        "l_partkey",
        "part",
        F.size("quantities").cast("bigint").alias("n_values"),
        F.array_join(F.col("quantities").cast("array<string>"), ",").alias("quantities"),
    )


@query("SELECT event_type AS value, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(F.col("event_type").alias("value"))
    return aggregates.group_count(events, "value")


@query("""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word
""")
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return word_counts(table(spark, sf, "documents"), "text").withColumnRenamed("count", "n")


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def sort_desc_topk(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ranking.top_k(orders, [F.desc("o_totalprice")], ["o_orderkey"], 20)


@query("""
    SELECT n_name, round(sum(c_acctbal), 2) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY balance DESC, n_name LIMIT 10
""")
def topk_by_sum(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    per_nation = _to(2, exact_totals(customer, ["c_nationkey"], sums={"balance": F.col("c_acctbal")}), "balance")
    nation = table(spark, sf, "nation")
    named = per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return ranking.top_k(named.select("n_name", "balance"), [F.desc("balance")], ["n_name"], 10)


@query("SELECT p_partkey, p_name FROM part ORDER BY length(p_name), p_name, p_partkey")
def sort_by_length(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return ranking.sort_by_length(parts, "p_name", ["p_partkey"])
