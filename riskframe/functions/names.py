"""Column names as they are, dots and quotes included."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quoted(name: str) -> str:
    """The name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """The column of exactly this name; a dot in it is no field access."""
    return F.col(quoted(name))
