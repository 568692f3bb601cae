"""Conditional replacement (B6) with a repeatable key-hash choice instead of a random one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def key_pick(key, n: int) -> Column:
    """Index 0..n-1 from the first 32 bits of the MD5 of the key's text: evenly spread for
    any kind of key, the same on every run and engine.  A null key is the empty text."""
    text = F.coalesce(_c(key).cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(n))


def replace_out_of_range(value, key, limit: int) -> Column:
    """value >= limit -> a key-hash choice in 1..limit, else value."""
    v = _c(value)
    return F.when(v >= F.lit(limit), key_pick(key, limit) + 1).otherwise(v)


def replace_not_in(value, allowed, key) -> Column:
    """value not in ``allowed`` (or null) -> a key-hash choice from it, else value."""
    allowed = list(allowed)
    v = _c(value)
    pick = F.element_at(F.array(*[F.lit(a) for a in allowed]), (key_pick(key, len(allowed)) + 1).cast("int"))
    return F.when(v.isin(allowed), v).otherwise(pick)
