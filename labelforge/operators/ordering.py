"""Globally sorted output and a distributed global rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelforge.operators.sizing import measured_bytes
from labelforge.session import written

# Rows that one task sorts, and rows in a row of a file that are compared as one piece.
SORT_BYTES, PIECE_BYTES = 64 << 20, 4 << 20


def range_sorted(df: DataFrame, keys: list[str], num_partitions: int | None = None,
                 partition_keys: list[str] | None = None) -> DataFrame:
    """total order across partitions: range partitioning on ``partition_keys``
    (default: all sort keys), then a sort by ``keys`` inside each partition (no
    single-task global sort).  Partitioning on a key prefix keeps all rows of one
    prefix value in one partition.  There are ``num_partitions`` (by default
    ``spark.sql.shuffle.partitions``, of which AQE may merge adjacent small ranges, which
    keeps the order intact), or more where a task would sort over ``SORT_BYTES``."""
    pkeys = partition_keys or keys
    parts = _parts(df.sparkSession, measured_bytes(df), num_partitions)
    ranged = df.repartitionByRange(parts, *pkeys) if parts else df.repartitionByRange(*pkeys)
    return ranged.sortWithinPartitions(*keys)


def _parts(spark: SparkSession, size: int, least: int | None = None) -> int | None:
    """Partitions for ``size`` bytes, at least ``least``; None: those of the session are enough."""
    needed = -(-size // SORT_BYTES)
    usual = least or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return needed if needed > usual else least


def order_check(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Whether the files at ``path``, read in the order of their names, hold one unbroken
    order of ``keys``; one row: ``rows``, ``files``, ``breaks_inside`` (rows less than the one before
    them in their file) and ``breaks_between`` (files that begin with less than an earlier one
    ends with).

    Rows meet by piece of a file, in their place there; pieces meet by file and files by one
    row each, so no task holds a whole file."""
    key = F.struct(*keys)
    rows = spark.read.parquet(path).select(key.alias("k"), F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("at"))
    size = measured_bytes(rows)
    long = max(1, PIECE_BYTES * rows.count() // max(1, size))
    pieces = rows.withColumn("piece", F.expr(f"at div {long}"))
    if parts := _parts(spark, size):
        pieces = pieces.repartition(parts, "file", "piece")
    before = F.lag("k").over(Window.partitionBy("file", "piece").orderBy("at"))
    told = pieces.withColumn("less", (before > F.col("k")).cast("long")).groupBy("file", "piece").agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("less"), F.lit(0)).alias("less"),
        F.min_by("k", "at").alias("first"), F.max_by("k", "at").alias("last"))
    # one row per piece
    ended = F.lag("last").over(Window.partitionBy("file").orderBy("piece"))
    told = told.withColumn("cut", F.coalesce((ended > F.col("first")).cast("long"), F.lit(0))).groupBy("file").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("less") + F.col("cut")).alias("less"),
        F.min_by("first", "piece").alias("first"), F.max_by("last", "piece").alias("last"))
    # one row per file
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    joined = told.withColumn("cut", (F.max("last").over(earlier) > F.col("first")).cast("long"))
    return joined.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"),
                      F.coalesce(F.sum("less"), F.lit(0)).alias("breaks_inside"),
                      F.coalesce(F.sum("cut"), F.lit(0)).alias("breaks_between"))


def global_rank(df: DataFrame, keys: list[str], out: str = "pos",
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in the total order of ``keys`` (ties in the order of
    a hash of the whole row, like ``row_number``), without a single-partition window.

    Rows are range-partitioned and sorted once, and written with the number of their
    partition and their place in it: range bounds come from a sample, so only one
    materialised partitioning may be counted and indexed.  The counts (one row per
    partition) become offsets that are added to the places.  The hash among the sort
    keys lets a key that holds a large share of the rows be split."""
    parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # at least
    mixed = df.withColumn("_tb", F.xxhash64(*[F.col(c) for c in df.columns]))
    ordered = range_sorted(mixed, keys + ["_tb"], parts).drop("_tb") \
        .withColumn("_pid", F.spark_partition_id()) \
        .withColumn("_idx", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    placed = written(ordered, "ranked")
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: this window is bounded by the partition count
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return placed.join(F.broadcast(offsets), "_pid") \
        .withColumn(out, F.col("_off") + F.col("_idx") + 1).drop("_pid", "_idx", "_off")
