"""Most frequent category per entity (M7: D3 + E1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mode_category(df: DataFrame, key: str, category: str, out: str = "mode",
                  key_alias: str = "userId") -> DataFrame:
    """Per key the category with the highest count; ties go to the smallest category.

    Two hash aggregates with map-side partial aggregation: (key, category) counts,
    then per key the minimum of ``(-count, category)``.  A key holding a third of
    all rows is reduced to at most (#categories x #map tasks) rows before its
    shuffle, so no task ever sees the raw hot group.  Null categories are not
    counted; a key with no rows gets no row.
    """
    counts = df.where(F.col(category).isNotNull()) \
        .groupBy(F.col(key).alias(key_alias), F.col(category).alias("_cat")).count()
    best = counts.groupBy(key_alias).agg(
        F.min(F.struct((-F.col("count")).alias("n"), F.col("_cat").alias("c"))).alias("_b"))
    return best.select(key_alias, F.col("_b.c").alias(out))
