"""From a raw file frame to the source of a merge."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.hashing import row_hash
from lakeload.functions.identifiers import brackets_to_backticks, column, parse_columns
from lakeload.functions.scalars import instant
from lakeload.schemas import ARCHIVE_FILE, ARCHIVED, MODIFIED, STAGING_NAME


def extract(df: DataFrame, columns: str | Sequence[str] = "*") -> DataFrame:
    """A free select list: text (brackets allowed) or a list of expressions."""
    if not isinstance(columns, str):
        return df.selectExpr(*[brackets_to_backticks(c) for c in columns])
    text = brackets_to_backticks(columns).replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(f"SELECT {text} FROM {{rows}}", rows=df)


def exclude(df: DataFrame, columns: str | Iterable[str] | None) -> DataFrame:
    return df.drop(*parse_columns(columns))


def with_partition_columns(df: DataFrame, expressions: str | Sequence[str] | None) -> DataFrame:
    """Append partition expressions such as ``year(OrderDate) as __year``."""
    if not expressions:
        return df
    if isinstance(expressions, str):
        return extract(df, "*, " + expressions)
    return extract(df, ["*", *expressions])


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(keys))


def underscore_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def complex_as_string(df: DataFrame, mode: str = "cast") -> DataFrame:
    """Arrays, structs and maps as text: Spark's cast, or JSON with ``mode="json"``."""

    def text(field: T.StructField):
        if not isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            return column(field.name)
        value = column(field.name)
        return (value.cast("string") if mode == "cast" else F.to_json(value)).alias(field.name)

    return df.select(*[text(f) for f in df.schema.fields])


def with_lineage(df: DataFrame, now, archive_ts, archive_path=None, staging_name=None) -> DataFrame:
    """Technical columns of one file, given as literals or as columns."""

    def text(value):
        return value if hasattr(value, "alias") else F.lit(value).cast("string")

    return df.withColumns(
        {
            MODIFIED: instant(now),
            ARCHIVED: instant(archive_ts),
            ARCHIVE_FILE: text(archive_path),
            STAGING_NAME: text(staging_name),
        }
    )


def prepare_source(
    df: DataFrame,
    columns: str | Sequence[str] = "*",
    excluded: str | Iterable[str] | None = None,
    partition_exprs: str | Sequence[str] | None = None,
    not_null_keys: Sequence[str] | None = None,
    rename_spaces: bool = False,
    complex_mode: str | None = None,
    hash_mode: str = "safe",
    hash_cols: Sequence[str] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Select, exclude, rename, filter and hash one extract.

    ``carry`` names technical columns that pass through outside the select list
    and outside the hash.
    """
    carried = [column(c).alias(f"__carry_{i}") for i, c in enumerate(carry)]
    if complex_mode:
        df = complex_as_string(df, complex_mode)
    payload = df.drop(*carry)
    if carried:
        # The user's list sees only payload columns; the carried ones travel as one extra struct.
        df = df.select(*[column(c) for c in payload.columns], F.struct(*carried).alias("__carry"))
        picked = _extract_beside(df, columns)
    else:
        picked = extract(df, columns)
    if partition_exprs:
        picked = with_partition_columns(picked, partition_exprs)
    picked = exclude(picked, excluded)
    if rename_spaces:
        picked = underscore_names(picked)
        picked = exclude(picked, [c.replace(" ", "_") for c in parse_columns(excluded)])
    if not_null_keys:
        picked = drop_null_keys(picked, not_null_keys)
    named = [c for c in picked.columns if c != "__carry"]
    picked = row_hash(picked, hash_cols or named, hash_mode)
    if carried:
        restored = [F.col(f"__carry.__carry_{i}").alias(c) for i, c in enumerate(carry)]
        picked = picked.select(*[column(c) for c in picked.columns if c != "__carry"], *restored)
    return picked


def _extract_beside(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    picked = extract(df, columns)
    if "__carry" in picked.columns:
        return picked
    return extract(df, columns + ", __carry" if isinstance(columns, str) else [*columns, "__carry"])
