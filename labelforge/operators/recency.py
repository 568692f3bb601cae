"""Recency tag (M6: D2 + H6/H8 + C3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelforge.functions.dates import days_since
from labelforge.operators.ranges import range_match


def last_event(df: DataFrame, key: str, time_col: str, time_kind: str = "timestamp",
               key_alias: str = "userId") -> DataFrame:
    """Latest time per key -> ``(userId, last_time)`` (partial + final hash aggregate).

    ``time_kind='epoch'`` reads epoch seconds held as text and compares them as
    numbers (text order would put "7" after "10").
    """
    t = F.col(time_col)
    if time_kind == "epoch":
        t = F.timestamp_seconds(t.try_cast("long"))
    elif time_kind != "timestamp":
        raise ValueError("time_kind must be 'timestamp' or 'epoch'")
    return df.groupBy(F.col(key).alias(key_alias)).agg(F.max(t).alias("last_time"))


def recency_tag(df: DataFrame, key: str, time_col: str, ranges: DataFrame, as_of: str,
                tag: str = "cycle", time_kind: str = "timestamp",
                key_alias: str = "userId") -> DataFrame:
    """Days since the latest event (to ``as_of``) tagged by closed day ranges.

    A key whose gap falls in no range gets no row (e.g. beyond the last range).
    """
    last = last_event(df, key, time_col, time_kind, key_alias)
    gaps = last.select(key_alias, days_since(F.col("last_time"), as_of).alias("_days"))
    return range_match(gaps, "_days", ranges, key=key_alias, tag=tag, bounds="closed",
                       key_alias=key_alias)
