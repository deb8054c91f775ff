"""Exact dedup: 128-bit content hash, bytes compared inside groups, smallest or largest id kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import ascii_lower, staged

_ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def content_key(text: Column) -> list[Column]:
    """128 bits of content: two 64-bit hashes of different seeds."""
    return [F.xxhash64(text).alias("__h1"), F.xxhash64(F.lit("second seed"), text).alias("__h2")]


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", columns=None
) -> DataFrame:
    """The rows of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  Copies meet in
    an aggregate on (hash, bytes): a task sends one row per distinct text, so a huge group of
    copies costs no more than a small one, and rows of equal hash but other bytes stay apart.
    Rows then find their group by the hash and a SHA-256 of the bytes; were two texts ever equal
    in all 384 bits, the job stops instead of merging them.

    Rows that repeat an id share its fate.  Rows with a null id are kept only in groups without
    any id (``keep_id`` is null there).  An empty table gives an empty result.  ``columns`` limits
    what is carried along; a column named like an added one is replaced.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    best = F.min if keep == "smallest" else F.max
    carried = docs.columns if columns is None else list(columns)
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried if c not in _ADDED]).alias("__row"),
        F.col(id_col).alias("__id"),
        text.alias("__text"),
    )
    groups = (
        base.select("__id", "__text", *content_key(F.col("__text")))
        .groupBy("__h1", "__h2", "__text")
        .agg(best("__id").alias("__keep"), F.count("*").alias("__n"))
        .select("__h1", "__h2", F.sha2("__text", 256).alias("__sha"), "__keep", "__n")
        .groupBy("__h1", "__h2", "__sha")
        .agg(
            best("__keep").alias("keep_id"),
            F.sum("__n").alias("group_size"),
            F.when(F.count("*") > 1, F.raise_error(F.lit("different texts share 384 bits of hash"))).alias("__clash"),
        )
    )
    # As a table of its own the join's shuffle can be split where a hash is hot.
    groups = staged(groups, "text-groups")
    rows = base.select("__row", "__id", *content_key(F.col("__text")), F.sha2("__text", 256).alias("__sha"))
    return rows.join(groups.where("__clash IS NULL"), ["__h1", "__h2", "__sha"]).select(
        "__row.*",
        "keep_id",
        "group_size",
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )
