"""Bulk casts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cast_all_double(df: DataFrame, keep: list[str] | tuple[str, ...] = ("id",),
                    columns: list[str] | None = None) -> DataFrame:
    """Every column except ``keep`` -> double in ONE projection.

    ``try_cast`` turns unparsable text into null (plain ``cast`` raises under ANSI).
    ``columns`` restricts the cast to a named list; the rest pass through.
    """
    target = set(columns) if columns is not None else set(df.columns) - set(keep)
    return df.select([F.col(c).try_cast("double").alias(c) if c in target else F.col(c)
                      for c in df.columns])


def positional_columns(columns: list[str], start: int = 1, stop: int | None = None) -> list[str]:
    """A positional slice of a column list (e.g. all but the key, or all but the
    key and the label).  Named feature lists are preferred; this keeps the
    positional form available for tables whose layout is fixed."""
    return list(columns)[start:stop]
