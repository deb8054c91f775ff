"""Clean-up of column lists given as text."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_columns(text: str | Iterable[str] | None) -> list[str]:
    """``"[a], `b` , c"`` -> ``["a", "b", "c"]``; empty text gives an empty list."""
    if text is None:
        return []
    parts = text.split(",") if isinstance(text, str) else text
    names = (re.sub(r"[\[\]`]", "", part).strip() for part in parts)
    return [name for name in names if name]


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str, of: str | None = None) -> Column:
    """Reference to a column (or to a field of the struct ``of``) by its exact name."""
    return F.col(quote(name) if of is None else f"{of}.{quote(name)}")


def brackets_to_backticks(text: str) -> str:
    """Bracket-quoted identifiers in a select list become Spark-quoted ones."""
    return re.sub(r"\[([^\]]*)\]", lambda m: quote(m.group(1)), text)


def catalog_name(path: str, prefix: str = "archive_") -> str:
    """Table name under which the log of an archive path is registered."""
    return prefix + re.sub(r"[/\\-]", "_", path.strip("/"))


def catalog_name_of(path: Column, prefix: str = "archive_") -> Column:
    """The same for a column of paths."""
    return F.concat(F.lit(prefix), F.regexp_replace(F.trim(path, F.lit("/")), r"[/\\-]", "_"))
