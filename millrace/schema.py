"""Schemas declared as ``(name, type)`` pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names a declaration may use.
TYPE_NAMES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "short": T.ShortType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "array_int": T.ArrayType(T.IntegerType()),
    "array_string": T.ArrayType(T.StringType()),
}


def declare_schema(columns: list[tuple]) -> T.StructType:
    """Nullable schema from pairs; ``(name, "struct", [pairs])`` nests to any depth."""
    return T.StructType([T.StructField(spec[0], _type_of(*spec), True) for spec in columns])


def _type_of(name: str, type_name: str, fields: list[tuple] | None = None) -> T.DataType:
    if type_name == "struct":
        if not isinstance(fields, list):
            raise ValueError(f"struct column {name!r} needs a list of sub-fields")
        return declare_schema(fields)
    if type_name not in TYPE_NAMES:
        raise ValueError(f"column {name!r} has unknown type {type_name!r}")
    return TYPE_NAMES[type_name]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a declared schema: its columns, its order, its types."""
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def describe_columns(df: DataFrame) -> list[tuple[str, str]]:
    """Names and types, without running a job."""
    return df.dtypes
