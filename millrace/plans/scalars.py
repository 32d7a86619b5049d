"""Dates, JSON, text, numbers and arrays."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import arrays, dates, documents, numbers, text
from millrace.operators import ranking
from millrace.plans.registry import query
from millrace.schema import declare_schema
from millrace.sources.files import map_text
from millrace.sources.streams import decode_value
from millrace.streaming.logs import parse_lines, render_line
from millrace.streaming.wordcount import word_counts
from millrace.tables import table


@query("""
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date
    FROM orders
""")
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    written = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(
        F.date_format("o_orderdate", "dd-MM-yyyy")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", written.alias("order_date_text"))
    parsed = orders.withColumn("order_date", dates.parse_date(F.col("order_date_text"), "dd-MM-yyyy"))
    return parsed.drop("order_date_text").withColumn("order_date", F.col("order_date").cast("string"))


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as server log lines."""
    line = render_line(
        F.col("ts"),
        F.upper("event_type"),
        F.concat(F.lit("event "), F.col("event_id").cast("string"), F.lit(" "), F.col("props")),
        F.col("user_id") % 5 + 1,
    )
    return table(spark, sf, "events").select("event_id", line.alias("value"))


def mixed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The same lines, each followed by one that is no log line."""
    events = table(spark, sf, "events").select("event_id", "props")
    junk = events.select("event_id", F.col("props").alias("value"))
    return event_lines(spark, sf).unionAll(junk).select("value")


LOG_FIELDS = """
    SELECT date_trunc('second', ts) AS timestamp, upper(event_type) AS level,
           'event ' || event_id || ' ' || props AS message,
           'server-node-' || (user_id % 5 + 1) AS server
    FROM events
"""


@query("""
    SELECT event_id,
           strftime(ts, '%Y-%m-%d %H:%M:%S') || ' | '
           || rpad(upper(event_type), greatest(5, length(event_type))::INTEGER, ' ')
           || ' | event ' || event_id || ' ' || props || ' | server-node-' || (user_id % 5 + 1) AS value
    FROM events
""")
def render_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    return event_lines(spark, sf)


def log_columns(parsed: DataFrame) -> DataFrame:
    time = F.col("timestamp").cast("timestamp_ntz").alias("timestamp")
    return parsed.select(time, "level", "message", "server")


@query(LOG_FIELDS)
def parse_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    return log_columns(parse_lines(mixed_lines(spark, sf)))


def _kafka_records(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines in the columns of a Kafka source."""
    return event_lines(spark, sf).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("server-logs").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
    )


@query(LOG_FIELDS.replace("SELECT ", 'SELECT event_id AS "offset", ', 1))
def kafka_value_decode(spark: SparkSession, sf: str) -> DataFrame:
    decoded = parse_lines(decode_value(_kafka_records(spark, sf), "offset"))
    time = F.col("timestamp").cast("timestamp_ntz").alias("timestamp")
    return decoded.select("offset", time, "level", "message", "server")


@query("""
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split(
        strftime(ts, '%Y-%m-%d %H:%M:%S') || ' | '
        || rpad(upper(event_type), greatest(5, length(event_type))::INTEGER, ' ')
        || ' | event ' || event_id || ' ' || props || ' | server-node-' || (user_id % 5 + 1), ' ')) AS word
    FROM events) GROUP BY word
""")
def kafka_word_count(spark: SparkSession, sf: str) -> DataFrame:
    decoded = decode_value(_kafka_records(spark, sf))
    return word_counts(decoded).withColumnRenamed("count", "n")


def _people(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as JSON text with a nested struct and an array; some lack the array."""
    payments = F.when(F.col("c_acctbal") > 0, F.array(F.col("c_nationkey"), F.length("c_name")))
    person = F.struct(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("age"),
        F.struct(F.col("c_mktsegment").alias("city"), F.col("c_nationkey").alias("zip")).alias("address"),
        payments.alias("payments"),
    )
    return table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.to_json(person).alias("json_col"))


@query("""
    SELECT c_custkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS age, c_mktsegment AS city,
           CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '0' END AS first_payment
    FROM customer
""")
def json_path(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("json_col")
    return (
        _people(spark, sf)
        .select(
            "c_custkey",
            documents.json_text(value, "$.name").alias("name"),
            documents.json_text(value, "$.age").alias("age"),
            documents.json_text(value, "$.address.city").alias("city"),
            documents.json_text(value, "$.payments[0]").alias("first_payment"),
        )
        .na.fill({"first_payment": 0})
    )


@query("""
    SELECT c_custkey, c_name AS name, c_mktsegment AS city,
           CAST(CASE WHEN c_acctbal > 0 THEN c_nationkey ELSE -1 END AS INTEGER) AS first_payment
    FROM customer WHERE c_nationkey <> 0
""")
def json_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Some texts are no JSON; they parse to a struct without a name and are left out."""
    schema = declare_schema(
        [
            ("name", "string"),
            ("age", "int"),
            ("address", "struct", [("city", "string"), ("zip", "string")]),
            ("payments", "array_int"),
        ]
    )
    people = _people(spark, sf)
    broken = F.when(F.col("c_nationkey") == 0, "not json").otherwise(F.col("json_col"))
    parsed = people.select("c_custkey", documents.json_struct(broken, schema).alias("parsed"))
    return parsed.filter(F.col("parsed.name").isNotNull()).select(
        "c_custkey",
        F.col("parsed.name").alias("name"),
        F.col("parsed.address.city").alias("city"),
        F.coalesce(documents.element(F.col("parsed.payments"), 0), F.lit(-1)).alias("first_payment"),
    )


@query("""
    SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total_k
    FROM events GROUP BY event_type
""")
def json_number_sum(spark: SparkSession, sf: str) -> DataFrame:
    key = documents.json_key(F.col("props"), "$.k")
    return table(spark, sf, "events").groupBy("event_type").agg(F.sum(key).alias("total_k"))


@query("SELECT p_partkey, round(p_retailprice * ln(p_size), 2) AS weighted_score FROM part")
def weighted_score(spark: SparkSession, sf: str) -> DataFrame:
    score = numbers.weighted_score(F.col("p_retailprice"), F.col("p_size"))
    parts = table(spark, sf, "part").select("p_partkey", F.round(score, 2).alias("weighted_score"))
    return ranking.sort_rows(parts, [F.desc("weighted_score")], ["p_partkey"])


@query("SELECT o_orderkey, o_custkey * o_custkey AS squared FROM orders")
def map_square(spark: SparkSession, sf: str) -> DataFrame:
    squared = numbers.square(F.col("o_custkey"))
    return table(spark, sf, "orders").select("o_orderkey", squared.alias("squared"))


@query("""
    SELECT p_partkey, list_aggregate(list_transform(string_split(p_name, ' '),
               lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS name
    FROM part
""")
def normalize_names(spark: SparkSession, sf: str) -> DataFrame:
    untidy = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", text.normalize_name(untidy).alias("name"))


@query("""
    SELECT doc_id, CAST(len(list_filter(list_transform(string_split(text, ' '), lambda w: length(w)),
                                   lambda n: n % 2 = 0)) AS BIGINT) AS even_words
    FROM documents
""")
def array_filter(spark: SparkSession, sf: str) -> DataFrame:
    lengths = arrays.map_elements(text.words(F.col("text")), F.length)
    even = arrays.keep_elements(lengths, lambda n: n % 2 == 0)
    return table(spark, sf, "documents").select("doc_id", F.size(even).cast("bigint").alias("even_words"))


@query("""
    SELECT doc_id, CAST(coalesce(list_sum(list_transform(string_split(text, ' '),
               lambda w: length(w) * length(w))), 0) AS BIGINT) AS squared_lengths
    FROM documents
""")
def array_transform(spark: SparkSession, sf: str) -> DataFrame:
    squares = arrays.map_elements(text.words(F.col("text")), lambda w: F.length(w) * F.length(w))
    return table(spark, sf, "documents").select(
        "doc_id", arrays.sum_elements(squares).alias("squared_lengths")
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey + l_partkey + l_suppkey + l_linenumber AS total
    FROM lineitem
""")
def row_sum(spark: SparkSession, sf: str) -> DataFrame:
    total = numbers.row_sum(*[F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", total.alias("total"))


PAGE_TEXT = """
    SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html,
               '<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'gs'),
               '<[^>]*>', ' ', 'gs'), '[ \\t\\r\\n]+', ' ', 'g')) AS text
    FROM pages
"""


@query(PAGE_TEXT)
def file_text_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Text of every page by column expressions, without leaving the JVM."""
    return table(spark, sf, "pages").select("page_id", text.html_text(F.col("html")).alias("text"))


def strip_tags(html: str) -> str:
    """The same text by a Python function."""
    bare = re.sub(r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ", html)
    return re.sub(r"[ \t\r\n]+", " ", re.sub(r"<[^>]*>", " ", bare)).strip(" ")


@query(PAGE_TEXT)
def python_text_extract(spark: SparkSession, sf: str) -> DataFrame:
    return map_text(table(spark, sf, "pages"), "page_id", "html", strip_tags)
