"""Columns that an operator passes through beside the ones it makes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def passed(docs: DataFrame, columns: list[str] | None, made: T.StructType) -> tuple[list[str], T.StructType]:
    """The columns of ``docs`` to pass through and the whole schema; made columns replace those of the same name."""
    names = {f.name for f in made.fields}
    kept = [f for f in docs.schema.fields if f.name not in names and (columns is None or f.name in columns)]
    return [f.name for f in kept], T.StructType([*kept, *made.fields])
