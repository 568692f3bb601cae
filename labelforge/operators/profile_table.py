"""Bucketed profile table: the long profile as a catalog table partitioned by tag
and bucketed (and sorted) by entity key.

A run appends its cells, with its name, to the buckets: only the NEW cells are
shuffled, the old profile, the big side, never moves and is never rewritten.  Readers
group by the bucket column, so the present state and the wide view need no shuffle
either.  As in the path store the log beside the table (``run_log``) orders the runs, makes
them visible when they are complete and knows which tags they replace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelforge.operators.profile import KEY, latest_cells
from labelforge.operators.run_log import RUN, RunLog, newest


def _ddl(name: str, path: str, buckets: int, key: str, key_type: str) -> str:
    return (f"CREATE TABLE IF NOT EXISTS {name} ({key} {key_type}, value STRING, version BIGINT, "
            f"run STRING, tag STRING) USING parquet PARTITIONED BY (tag) CLUSTERED BY ({key}) "
            f"SORTED BY ({key}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")


def create_profile_table(spark: SparkSession, name: str, path: str, buckets: int,
                         key: str = KEY, key_type: str = "BIGINT") -> None:
    """Create (if absent) the bucketed long profile table at ``path``."""
    spark.sql(_ddl(name, path, buckets, key, key_type))


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _append(cells: DataFrame, name: str, run: str | int | None, key: str, replaced: list[str]) -> None:
    told = _described(cells.sparkSession, name)
    log = RunLog(cells.sparkSession, told["Location"])
    claimed = log.claim(run)
    cells.select(key, "value", "version", F.lit(claimed).alias(RUN), "tag") \
        .repartition(int(told["Num Buckets"]), key).sortWithinPartitions("tag", key) \
        .write.insertInto(name)
    log.commit(claimed, replaced)


def replace_tags(long: DataFrame, name: str, tags: list[str] | None = None, key: str = KEY,
                 run: str | int | None = None) -> None:
    """The run's cells are all that is left of ``tags`` (without it: the tags in ``long``)."""
    named = list(tags) if tags is not None else [r["tag"] for r in long.select("tag").distinct().collect()]
    _append(latest_cells(long, key), name, run, key, named)


def upsert_tags(long: DataFrame, name: str, tags: list[str] | None = None, key: str = KEY,
                run: str | int | None = None) -> None:
    """Per tag: new value where the run has one, else the old value (keys only in
    the old profile keep their cell).  ``tags`` restricts the run to those tags."""
    own = long.where(F.col("tag").isin(tags)) if tags is not None else long
    _append(latest_cells(own, key), name, run, key, [])


def present(spark: SparkSession, name: str, tags: list[str], key: str = KEY) -> DataFrame:
    """Cells ``(key, tag, value)`` that are left of ``tags``, without a shuffle of the table."""
    runs = RunLog(spark, _described(spark, name)["Location"]).runs()
    return newest(spark.table(name).where(F.col("tag").isin(tags) & runs.visible()), key)


def wide_view(spark: SparkSession, name: str, tags: list[str], key: str = KEY) -> DataFrame:
    """Wide profile from the bucketed table (the aggregates reuse the bucketing)."""
    cells = present(spark, name, tags, key)
    return cells.groupBy(key).agg(*[F.max(F.when(F.col("tag") == t, F.col("value"))).alias(t) for t in tags])


def lookup(spark: SparkSession, name: str, key_value, tags: list[str], key: str = KEY) -> DataFrame:
    """A15/B8 by key: one entity's cells.  The equality on the bucket column prunes
    the scan to a single bucket per tag partition."""
    return present(spark, name, tags, key).where(F.col(key) == F.lit(key_value))


def compact(spark: SparkSession, name: str, target: str, path: str, tags: list[str],
            key: str = KEY, key_type: str = "BIGINT") -> None:
    """The present state of ``tags`` as a new table ``target`` at ``path``, one run."""
    create_profile_table(spark, target, path, int(_described(spark, name)["Num Buckets"]), key, key_type)
    _append(present(spark, name, tags, key).withColumn("version", F.lit(0).cast("long")), target, None, key, [])
