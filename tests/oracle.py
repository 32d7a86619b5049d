"""Comparison of a Spark result with DuckDB's result of the oracle SQL."""

from __future__ import annotations

import duckdb

from millrace.tables import NAMES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    """Rows as sorted text, columns in name order; floats keep 12 digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        if value is None or value != value:
            return "null"
        if isinstance(value, float):
            return f"{value:.12g}"
        return str(value)

    return [columns[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    spark_side = canonical(df.columns, df.collect())
    cursor = con.execute(sql)
    duck_side = canonical([d[0] for d in cursor.description], cursor.fetchall())
    return spark_side, duck_side
