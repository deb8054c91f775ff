"""Relational staging tables and warehouse tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeload.functions.identifiers import quote

# Text width and placement of warehouse tables unless given.
MAX_STRING_LENGTH = 250
DISTRIBUTION = "ROUND_ROBIN"
BATCH_ROWS = 10_000


def text_types(schema: T.StructType, length: int) -> str:
    """Column types that bound every text column, for ``createTableColumnTypes``."""
    return ", ".join(
        f"{quote(f.name)} VARCHAR({length})" for f in schema.fields if isinstance(f.dataType, T.StringType)
    )


def warehouse_options(schema: T.StructType, distribution: str, max_length: int | str) -> dict[str, str]:
    options = {"createTableOptions": f"WITH (DISTRIBUTION = {distribution}, HEAP)"}
    if str(max_length).upper() != "MAX":
        types = text_types(schema, int(max_length))
        if types:
            options["createTableColumnTypes"] = types
    return options


def _write(df: DataFrame, url: str, table: str, mode: str, connections: int | None, options: dict) -> None:
    writer = df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, batchsize=str(BATCH_ROWS), **options)
    if connections:
        # Spark coalesces to this many writing tasks; the database sees no more connections.
        writer = writer.option("numPartitions", connections)
    writer.save()


def overwrite_jdbc(df: DataFrame, url: str, table: str, connections: int | None = None, **options) -> None:
    """Replace a staging table; each task writes its rows over a connection of its own."""
    _write(df, url, table, "overwrite", connections, options)


def overwrite_warehouse(
    df: DataFrame,
    url: str,
    table: str,
    distribution: str = DISTRIBUTION,
    max_length: int | str = MAX_STRING_LENGTH,
    connections: int | None = None,
    **options,
) -> None:
    """Replace a warehouse table.

    With ``max_length="MAX"`` an empty frame creates the table with unbounded text
    first, then the rows are appended.
    """
    options = {**warehouse_options(df.schema, distribution, max_length), **options}
    if str(max_length).upper() == "MAX":
        empty = df.sparkSession.createDataFrame([], df.schema)
        _write(empty, url, table, "overwrite", None, options)
        _write(df, url, table, "append", connections, {})
    else:
        _write(df, url, table, "overwrite", connections, options)
