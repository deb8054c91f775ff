"""Schema evolution: new columns join in, types widen, nothing is dropped."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.identifiers import column, quote


def common_schema(left: DataFrame, right: DataFrame) -> T.StructType:
    """All columns of both sides with the wider type; incompatible types raise."""
    fields = {f.name: f for f in left.schema.fields}
    for field in right.schema.fields:
        seen = fields.get(field.name)
        if seen is None:
            fields[field.name] = field
        elif seen.dataType != field.dataType:
            fields[field.name] = T.StructField(field.name, _wider(left, right, field.name), True)
    return T.StructType(list(fields.values()))


def _wider(left: DataFrame, right: DataFrame, name: str) -> T.DataType:
    a, b = left.schema[name].dataType, right.schema[name].dataType
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    # Spark widens text and numbers to each other; a table column must not.
    if isinstance(a, T.StringType) != isinstance(b, T.StringType):
        raise TypeError(f"column {name}: {a.simpleString()} and {b.simpleString()} are not compatible")
    return left.select(column(name)).union(right.select(column(name))).schema[0].dataType


def conform(df: DataFrame, schema: T.StructType, fill: bool = True) -> DataFrame:
    """Cast to ``schema``; absent columns become NULL, or stay absent with ``fill=False``."""
    have = {f.name: f.dataType for f in df.schema.fields}
    if all(have.get(f.name) == f.dataType for f in schema.fields if fill or f.name in have):
        return df.select(*[quote(f.name) for f in schema.fields if f.name in have])
    return df.select(
        *[
            (column(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
            if fill or f.name in have
        ]
    )


def align_schemas(target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Target with every column, source with its own columns, both in the common types."""
    schema = common_schema(target, source)
    return conform(target, schema), conform(source, schema, fill=False)


def union_drifting(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of files whose schemas drifted: missing columns NULL, types widened."""

    def add(left: DataFrame, right: DataFrame) -> DataFrame:
        schema = common_schema(left, right)
        return conform(left, schema).union(conform(right, schema))

    return reduce(add, frames)
