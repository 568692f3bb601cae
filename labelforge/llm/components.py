"""Connected components by alternating large-star and small-star rounds.

Every step aggregates a minimum (combined before the shuffle) and joins it back,
so a hub node never gathers its neighbours in one task; Spark splits a skewed join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelforge.llm.common import discard, fresh_path


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` (orderable ids, u <> v) -> ``(node, root)``, root = smallest id of
    the component; the root itself is listed too.  No edges: an empty frame.

    Each round is written to the shared folder, and the round before it deleted."""
    spark, path = edges.sparkSession, ""

    def stored(df: DataFrame) -> DataFrame:
        nonlocal path
        last, path = path, fresh_path(spark, "components")
        df.write.parquet(path)
        if last:
            discard(spark, last)
        return spark.read.schema(df.schema).parquet(path)

    current = stored(edges.select("u", "v").where("u <> v").distinct())
    state = _signature(current)
    while state[0]:
        current = stored(_small_star(_large_star(current)))
        before, state = state, _signature(current)
        if before == state:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
