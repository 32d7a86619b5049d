"""Database, document-store and graph-store sinks.

Each is a set of connector options around ``DataFrame.write``; the connector itself is a jar that
the session loads. ``fmt`` lets a caller without the connector write the same rows to files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.operators.graph import matched_relationships, unique_nodes
from millrace.sources.jdbc import Jdbc


def jdbc_options(db: Jdbc, table: str, connections: int, batch_size: int) -> dict[str, str]:
    return {
        **db.options(table),
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
    }


def write_jdbc(
    df: DataFrame,
    db: Jdbc,
    table: str,
    mode: str = "overwrite",
    connections: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Each task writes over its own connection; ``connections`` bounds how many there are."""
    options = jdbc_options(db, table, connections, batch_size)
    df.write.format("jdbc").options(**options).mode(mode).save()


def document_options(uri: str, database: str, collection: str) -> dict[str, str]:
    return {"connection.uri": uri, "database": database, "collection": collection}


def write_documents(
    df: DataFrame, options: dict[str, str], fmt: str = "mongodb", mode: str = "overwrite"
) -> None:
    """One document per row, arrays of structs as nested documents."""
    df.write.format(fmt).options(**options).mode(mode).save()


def node_options(url: str, label: str, key: str) -> dict[str, str]:
    return {"url": url, "labels": f":{label}", "node.keys": key}


def relationship_options(url: str, name: str, label: str, key: str) -> dict[str, str]:
    return {
        "url": url,
        "relationship": name,
        "relationship.save.strategy": "keys",
        "relationship.source.labels": f":{label}",
        "relationship.source.save.mode": "match",
        "relationship.source.node.keys": f"src:{key}",
        "relationship.target.labels": f":{label}",
        "relationship.target.save.mode": "match",
        "relationship.target.node.keys": f"dst:{key}",
    }


GRAPH_FORMAT = "org.neo4j.spark.DataSource"


def write_nodes(
    nodes: DataFrame,
    key: str,
    options: dict[str, str],
    fmt: str = GRAPH_FORMAT,
    mode: str = "overwrite",
) -> None:
    """One node per key."""
    unique_nodes(nodes, key).write.format(fmt).options(**options).mode(mode).save()


def write_relationships(
    edges: DataFrame,
    nodes: DataFrame,
    options: dict[str, str],
    fmt: str = GRAPH_FORMAT,
    mode: str = "overwrite",
) -> None:
    """Edges between existing nodes only."""
    matched_relationships(edges, nodes).write.format(fmt).options(**options).mode(mode).save()
