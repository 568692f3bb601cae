"""Range tagging (C3 closed ranges, C4 left-open ranges) as an exact equi-join.

The distinct end points of the ranges cut the value axis into pieces (each point, and
each gap between two points).  A range covers a run of pieces, which falls apart into
few aligned blocks of 1, 2, 4, ... pieces; a value lies in one piece, and so in one block
of each size.  Joining on the block therefore pairs a value with the ranges that cover
it and no others, however the ranges lie: n ranges give at most 2n log n rows, and no
width, count or overlap makes a value probe ranges beside it.

Pieces are numbered in one of two ways.  Up to ``AXIS_POINTS`` end points are the splits of a
Bucketizer, which finds a value's piece by binary search in the scan (``Axis``).  More than
that never leave the executors (``swept``): points are ranked by a range-partitioned sort, and
values and bounds are swept together in the order of the axis, the last point of a partition
being carried into those behind it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from labelforge.operators.ordering import global_rank
from labelforge.operators.sizing import (DEFAULT_SALT_BUCKETS, MAX_BROADCAST_BYTES, measured_bytes,
                                        sized_join)
from labelforge.session import written

BOUNDS = ("closed", "left_open")
# Distinct end points that a query plan carries; more are swept.
AXIS_POINTS = 4096


def _predicate(x: Column, start: Column, end: Column, bounds: str) -> Column:
    if bounds == "closed":
        return x.between(start, end)
    if bounds == "left_open":
        return (x > start) & (x <= end)
    raise ValueError(f"bounds must be one of {BOUNDS}")


@dataclass
class Axis:
    """The pieces that a few end points make, numbered in their order."""

    points: list[float]
    levels: list[int] = field(default_factory=list)  # sizes of the blocks that the ranges use

    def place(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """``df`` with the piece ``out`` (long) of each double in ``column``; null and NaN have
        none."""
        splits = [x for p in self.points for x in (p, math.nextafter(p, math.inf))]
        splits = [-math.inf, *sorted({x for x in splits if abs(x) != math.inf}), math.inf]
        # a point's piece ends at the next double
        raw, given, value = f"{out}_split", f"{out}_value", F.col(column)
        found = Bucketizer(splits=splits, inputCol=given, outputCol=raw, handleInvalid="keep") \
            .transform(df.withColumn(given, one_zero(value)))
        return found.withColumn(out, F.when(value.isNotNull() & ~F.isnan(value), F.col(raw).cast("long"))) \
            .drop(raw, given)


def one_zero(x: Column) -> Column:
    """The double without the sign of a zero."""
    return F.when(x == 0, F.lit(0.0)).otherwise(x)


def axis_of(ranges: DataFrame, most: int = AXIS_POINTS) -> Axis | None:
    """The axis of ``ranges(_s, _e)`` (doubles), or None if they have more end points than
    ``most``; no more than that reach the driver."""
    points = ranges.select(F.explode(F.array("_s", "_e")).alias("p")).distinct().limit(most + 1).collect()
    return Axis(sorted(r["p"] for r in points)) if len(points) <= most else None


def blocks_column(first: Column, last: Column, pieces: int) -> Column:
    """The aligned blocks (level in the low 6 bits) that make up pieces first .. last: at each
    level an odd first and an even last block that no larger one covers."""
    def at(level):
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        a = F.call_function("shiftright", first + size - 1, level)
        b = F.call_function("shiftright", last + 1, level) - 1
        low, high = F.when((a <= b) & (a % 2 == 1), a * 64 + level), F.when((a <= b) & (b % 2 == 0), b * 64 + level)
        return F.array(low, high)
    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(pieces.bit_length())), at)))


def block_column(piece: Column, levels: list[int]) -> Column:
    """The blocks a piece lies in, of the given levels."""
    return F.transform(F.array(*[F.lit(v) for v in levels]),
                       lambda level: F.call_function("shiftright", piece, level) * 64 + level)


def range_blocks(ranges: DataFrame, axis: Axis) -> DataFrame:
    """``ranges(_s, _e, ...)`` with one row per block ``_b``."""
    placed = axis.place(axis.place(ranges, "_s", "_first"), "_e", "_last")
    blocks = blocks_column(F.col("_first"), F.col("_last"), 2 * len(axis.points) + 2)
    return placed.withColumn("_b", F.explode(blocks)).drop("_first", "_last")


def levels_of(blocks: DataFrame) -> list[int]:
    """Levels of the blocks ``_b`` (at most 64 values)."""
    return sorted(r[0] for r in blocks.select(F.col("_b").bitwiseAND(F.lit(63)).cast("int")).distinct().collect())


def _sweep(it):
    """Rows in the order of the axis -> the last point up to each, as far as its partition tells:
    ``_rank`` and ``_at``, null before its first point."""
    rank, at = None, None
    for batch in it:
        table = pa.Table.from_batches([batch])
        own = table.column("_rank").to_numpy(zero_copy_only=False).astype(float)
        x = table.column("_v").to_numpy()
        row = np.maximum.accumulate(np.where(np.isnan(own), -1, np.arange(len(own))))
        seen = row >= 0
        ranks = np.where(seen, own[np.maximum(row, 0)], np.nan if rank is None else rank)
        ats = np.where(seen, x[np.maximum(row, 0)], np.nan if at is None else at)
        if len(own) and not np.isnan(ranks[-1]):
            rank, at = ranks[-1], ats[-1]
        arrays = {"_rank": pa.array(np.where(np.isnan(ranks), 0, ranks).astype(np.int64), pa.int64(),
                                    mask=np.isnan(ranks)),
                  "_at": pa.array(ats, pa.float64(), mask=np.isnan(ranks))}
        for name in table.column_names:
            if name not in arrays:
                arrays[name] = table.column(name)
        yield from pa.table(arrays).select([*[c for c in table.column_names if c != "_at"], "_at"]).to_batches()


def swept(values: DataFrame, points: DataFrame, column: str = "_v") -> DataFrame:
    """``values`` with their piece ``_piece`` on the axis of ``points(_p, _rank)``, where
    ``_rank`` counts from 1.  ``column``: the double to place (not null, not NaN).

    Values and points are sorted together by ranges of the axis; a value that is repeated very
    often spans several partitions, as the sort goes on by a hash of the row."""
    spark, kept = values.sparkSession, values.columns
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = values.select(F.lit(None).cast("long").alias("_rank"), F.col(column).alias("_v"),
                         F.struct(*kept).alias("_row"), F.lit(1).alias("_kind"),
                         F.xxhash64(*kept).alias("_mix"))
    marks = points.select("_rank", F.col("_p").alias("_v"),
                          F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), F.lit(0).alias("_kind"),
                          F.lit(0).cast("long").alias("_mix"))
    order = ["_v", "_kind", "_mix"]
    sorted_rows = rows.unionByName(marks).repartitionByRange(parts, *order).sortWithinPartitions(*order) \
        .select("_rank", "_v", "_row", F.spark_partition_id().alias("_pid"))
    schema = StructType([*sorted_rows.schema.fields, StructField("_at", DoubleType())])
    found = written(sorted_rows.mapInArrow(_sweep, schema), "swept")
    # the last point of each partition and of those before it: one row per partition
    ends = found.groupBy("_pid").agg(F.max(F.struct("_rank", "_at")).alias("_end"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_pid", F.max("_end").over(before).alias("_carried"))
    last = F.when(F.col("_rank").isNotNull(), F.struct("_rank", "_at")).otherwise(F.col("_carried"))
    rank, at = F.coalesce(last["_rank"], F.lit(0)), last["_at"]
    piece = F.when(at == F.col("_v"), 2 * rank - 1).otherwise(2 * rank)
    return found.where(F.col("_row").isNotNull()).join(F.broadcast(carried), "_pid") \
        .select("_row.*", piece.alias("_piece"))


def _swept_blocks(ranges: DataFrame, max_broadcast_bytes: int, salt_buckets: int) -> tuple[DataFrame, DataFrame]:
    """(``ranges`` with one row per block ``_b``, their ranked end points)."""
    points = ranges.select(F.explode(F.array("_s", "_e")).alias("_p")).distinct()
    points = written(global_rank(points, ["_p"], "_rank").select("_p", F.col("_rank").cast("long").alias("_rank")),
                     "points")
    size, out = measured_bytes(points), ranges
    for bound, piece in (("_s", "_first"), ("_e", "_last")):
        named = points.select(F.col("_p").alias("_q"), (2 * F.col("_rank") - 1).alias(piece))
        out = sized_join(out, named, lambda a, b, c=bound: a[c] == b["_q"], "inner", ["_name", "_s", "_e"],
                         max_broadcast_bytes, size, salt_buckets).drop("_q", "_salt", "_rsalt")
    blocks = out.withColumn("_b", F.explode(blocks_column(F.col("_first"), F.col("_last"), 2 * points.count() + 2)))
    return written(blocks.drop("_first", "_last"), "range-blocks"), points


def range_match(df: DataFrame, value, ranges: DataFrame, key: str = "id", tag: str = "tag",
                bounds: str = "closed", start_col: str = "start", end_col: str = "end",
                name_col: str = "name", key_alias: str = "userId",
                max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                salt_buckets: int = DEFAULT_SALT_BUCKETS,
                axis_points: int = AXIS_POINTS) -> DataFrame:
    """Tag each row with every range containing ``value`` -> ``(userId, <tag>)``.

    A value in no range (or null, or NaN) gives no row; overlapping ranges give several.
    Ranges with a null or NaN bound, or with start > end, match nothing.
    """
    if bounds not in BOUNDS:
        raise ValueError(f"bounds must be one of {BOUNDS}")
    x = F.col(value) if isinstance(value, str) else value
    left = df.select(F.col(key).alias(key_alias), x.alias("_x")).where(F.col("_x").isNotNull())
    start, end = F.col("_s0").cast("double"), F.col("_e0").cast("double")
    r = ranges.select(F.col(name_col).alias("_name"), F.col(start_col).alias("_s0"),
                      F.col(end_col).alias("_e0")) \
        .where((F.col("_s0") <= F.col("_e0")) & ~F.isnan(start) & ~F.isnan(end)) \
        .withColumn("_s", one_zero(start)).withColumn("_e", one_zero(end))
    axis = axis_of(r, axis_points)
    x = F.col("_x").cast("double")
    if axis is not None:
        blocks = range_blocks(r, axis)
        placed = axis.place(left.withColumn("_v", x), "_v", "_piece")
    else:
        blocks, points = _swept_blocks(r, max_broadcast_bytes, salt_buckets)
        placed = swept(left.withColumn("_v", one_zero(x)).where(~F.isnan("_v")), points)
    keyed = placed.select(key_alias, "_x", F.explode(block_column(F.col("_piece"), levels_of(blocks))).alias("_b"))
    matched = sized_join(
        keyed, blocks.select("_name", "_s0", "_e0", F.col("_b").alias("_rb")),
        lambda a, b: (a["_b"] == b["_rb"]) & _predicate(a["_x"], b["_s0"], b["_e0"], bounds),
        "inner", [key_alias, "_x"], max_broadcast_bytes, salt_buckets=salt_buckets)
    return matched.select(key_alias, F.col("_name").alias(tag))
