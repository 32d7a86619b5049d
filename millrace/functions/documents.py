"""JSON held in string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_text(column: Column, path: str) -> Column:
    """Value at a JSON path as text; NULL where the path or the JSON is bad."""
    return F.get_json_object(column, path)


def json_key(column: Column, path: str, type_name: str = "bigint") -> Column:
    """Value at a JSON path as a typed join key. Text that is not of the type gives NULL, which
    joins with nothing, instead of an error that ends the job."""
    return F.get_json_object(column, path).try_cast(type_name)


def json_struct(column: Column, schema: T.StructType) -> Column:
    """Typed struct. Bad JSON gives a struct whose fields are all NULL: test a required field."""
    return F.from_json(column, schema)


def element(column: Column, position: int) -> Column:
    """Array element, NULL when out of bounds."""
    return F.get(column, F.lit(position))
