"""Row hashes that decide whether a row changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.identifiers import column
from lakeload.schemas import HASH


def _as_text(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column(field.name), {"ignoreNullFields": "false"})
    if isinstance(field.dataType, T.BinaryType):
        return F.base64(column(field.name))
    return column(field.name).cast("string")


def hash_expression(schema: T.StructType, cols: Sequence[str] | None = None, mode: str = "safe") -> Column:
    """SHA-256 over the chosen columns, in order.

    ``concat``  values joined by ``||``; NULLs are skipped, so ``(a, NULL, b)`` and
                ``(a, b, NULL)`` collide.  Kept for tables hashed this way before.
    ``json``    the row as a JSON object; NULL fields are left out, structs are fine.
    ``safe``    every value that is not NULL carries its column and its length, in the order of
                column names, so two different rows never give the same text, and a row's hash
                does not depend on columns that only other files of its batch have.
    """
    names = list(cols) if cols is not None else schema.fieldNames()
    if mode == "concat":
        text = F.concat_ws("||", *[column(c) for c in names])
    elif mode == "json":
        text = F.to_json(F.struct(*[column(c) for c in names]))
    elif mode == "safe":
        parts = []
        for name in sorted(names):
            value = _as_text(schema[name])
            head = F.lit(f"{len(name)}:{name}=")
            parts.append(F.coalesce(F.concat(head, F.length(value).cast("string"), F.lit(":"), value), F.lit("")))
        text = F.concat(*parts)
    else:
        raise ValueError(f"unknown hash mode: {mode}")
    return F.sha2(text, 256)


def row_hash(df: DataFrame, cols: Sequence[str] | None = None, mode: str = "safe", name: str = HASH) -> DataFrame:
    """Append the row hash.  ``cols`` pins the hash when the schema evolves."""
    return df.withColumn(name, hash_expression(df.schema, cols, mode))
