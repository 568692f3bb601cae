"""Size-checked joins.

One rule for every join with a rule, range or lookup side: its bytes are measured by one
aggregate; within the bound it is broadcast, beyond it the join is shuffled on the key and
a salt, so that one value holding a third of the big side is spread over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A broadcast side is held by the driver and by every executor.
MAX_BROADCAST_BYTES = 32 << 20
# The big side's rows of one key go to this many tasks; the other side is repeated in each.
DEFAULT_SALT_BUCKETS = 16
# Bytes of a row and of a field beside its text.
_ROW_BYTES, _FIELD_BYTES = 16, 8


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` in memory, from the length of every value (one job)."""
    fields = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + _FIELD_BYTES
                  for c in df.columns), F.lit(_ROW_BYTES))
    return int(df.agg(F.sum(fields.cast("long")).alias("n")).first()["n"] or 0)


def salt_column(key_cols, buckets: int) -> Column:
    """Deterministic salt in [0, buckets) from the row's own key columns, so a
    recomputed task assigns every row to the same bucket."""
    return F.pmod(F.xxhash64(*key_cols), F.lit(buckets)).cast("int")


def replicate_salts(df: DataFrame, buckets: int, name: str = "_salt") -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))


def sized_join(left: DataFrame, right: DataFrame, on, how: str, spread: list[str],
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES, known_bytes: int | None = None,
               salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """``left`` joined with ``right`` by the condition ``on(left, right)``.

    ``how``: inner or left.  ``spread`` names the columns of ``left`` whose hash salts a
    shuffled join.  ``known_bytes``: an upper bound for ``right`` that is known already."""
    size = measured_bytes(right) if known_bytes is None else known_bytes
    if size <= max_broadcast_bytes:
        return left.join(F.broadcast(right), on(left, right), how)
    left = left.withColumn("_salt", salt_column([F.col(c) for c in spread], salt_buckets))
    right = replicate_salts(right, salt_buckets, "_rsalt")
    return left.join(right, on(left, right) & (left["_salt"] == right["_rsalt"]), how)
