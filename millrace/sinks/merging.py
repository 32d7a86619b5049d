"""Tables that are merged into by key, for sinks that run again.

A store is a folder of versions, each a whole table, and of marks, one per finished version. Writers add a version
and mark it last; readers take the last one marked. A writer that fails in between leaves a version
that no one reads, and the next run writes another. Two writers at a time are not supported.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.graph import matched_relationships, unique_nodes

MARK = "number bigint, folder string"


def _last(spark: SparkSession, path: str) -> tuple[int, str] | None:
    try:
        marks = spark.read.schema(MARK).parquet(f"{path}/marks")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = marks.agg(F.max(F.struct("number", "folder"))).first()[0]
    return None if last is None else (last["number"], last["folder"])


def read_merged(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a store; None if nothing has been written."""
    last = _last(spark, path)
    return None if last is None else spark.read.parquet(f"{path}/versions/{last[1]}")


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides, one per key. Where both have one, the new one's columns count, NULL included, and
    columns that only the old one has stay. NULL keys are keys like any other. Keys have to be unique on each side."""
    wanted = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    mine = old.select(*[F.col(f"`{c}`").alias(f"_old_{c}") for c in old.columns], F.lit(True).alias("_is_old"))
    yours = new.select(*[F.col(f"`{c}`").alias(f"_new_{c}") for c in new.columns], F.lit(True).alias("_is_new"))
    on = [F.col(f"`_old_{k}`").eqNullSafe(F.col(f"`_new_{k}`")) for k in keys]
    both = mine.join(yours, on, "full")

    def value(c: str):
        if c not in old.columns:
            return F.col(f"`_new_{c}`")
        if c not in new.columns:
            return F.col(f"`_old_{c}`")
        return F.when(F.col("_is_new"), F.col(f"`_new_{c}`")).otherwise(F.col(f"`_old_{c}`"))

    return both.select(*[value(c).alias(c) for c in wanted])


def merge_into(spark: SparkSession, df: DataFrame, keys: list[str], path: str) -> int:
    """Merge rows, unique in ``keys``, into the store below ``path``; the number of the version. Merged again,
    the same rows change nothing."""
    last = _last(spark, path)
    number, folder = (1 if last is None else last[0] + 1), uuid.uuid4().hex
    rows = df if last is None else merged(spark.read.parquet(f"{path}/versions/{last[1]}"), df, keys)
    rows.write.parquet(f"{path}/versions/{folder}")
    spark.createDataFrame([(number, folder)], MARK).coalesce(1).write.mode("append").parquet(f"{path}/marks")
    return number


def merge_nodes(spark: SparkSession, nodes: DataFrame, key: str, path: str) -> int:
    """Create the nodes whose key is new and update the others. Rows that repeat a key count once."""
    return merge_into(spark, unique_nodes(nodes, key), [key], path)


def merge_relationships(spark: SparkSession, edges: DataFrame, nodes_path: str, path: str, key: str = "id") -> int:
    """Create or update one relationship per ``src`` and ``dst``, between nodes that are stored; others are left out."""
    nodes = read_merged(spark, nodes_path)
    if nodes is None:
        raise ValueError(f"no nodes have been written to {nodes_path}")
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    single = edges.select("src", "dst").distinct()
    if rest:
        single = edges.groupBy("src", "dst").agg(F.min(F.struct(*rest)).alias("_row")).select("src", "dst", "_row.*")
    return merge_into(spark, matched_relationships(single, nodes, key), ["src", "dst"], path)
