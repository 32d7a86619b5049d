"""Server log lines: ``yyyy-MM-dd HH:mm:ss | LEVEL | message | server-node-N``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.dates import parse_timestamp
from millrace.functions.documents import element

# The wire format of a log line.
SEPARATOR = " | "
SEPARATOR_PATTERN = r" \| "
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
LEVEL_WIDTH = 5
SERVER_PREFIX = "server-node-"

LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def render_line(time: Column, level: Column, message: Column, server_number: Column) -> Column:
    """One log line; a level shorter than the column is padded, a longer one kept whole. NULL fields are
    empty text, so that the others keep their places."""
    level, message = (F.coalesce(field, F.lit("")) for field in (level, message))
    width = F.greatest(F.lit(LEVEL_WIDTH), F.length(level))
    return F.concat_ws(
        SEPARATOR,
        F.coalesce(F.date_format(time, TIME_PATTERN), F.lit("")),
        F.rpad(level, width, " "),
        message,
        F.coalesce(F.concat(F.lit(SERVER_PREFIX), server_number.cast("string")), F.lit("")),
    )


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Fields of each line, for a table or a stream; lines without a valid time are dropped."""
    parts = F.split(F.col(column), SEPARATOR_PATTERN)
    kept = [c for c in lines.columns if c != column]
    return (
        lines.select(*kept, parts.alias("_parts"))
        .select(
            *kept,
            parse_timestamp(element(F.col("_parts"), 0), TIME_PATTERN).alias("timestamp"),
            *[
                F.trim(element(F.col("_parts"), i)).alias(name)
                for i, name in enumerate(("level", "message", "server"), start=1)
            ],
        )
        .filter(F.col("timestamp").isNotNull())
    )


def summarize(parsed: DataFrame) -> DataFrame:
    """Lines per server and level."""
    return parsed.groupBy("server", "level").count()
