"""Many row-level tag models over ONE scan of a business table.

Match, range and copy models that read the same table are evaluated together:

1. one projection of the scanned rows into a long frame
   ``(userId, tag, s, x)`` -- one row per (entity, model), ``s`` the value as
   text and ``x`` as a double;
2. one join with the union of all models' rules, keyed by ``(tag, k)`` where
   ``k`` is the value for match models, the value's bucket id for range models
   (ranges listed once per bucket they touch, as in ``range_match``) and the
   empty string for copy models, the exact range predicate being a join condition;
3. the tagged long frame, ready for a single profile write.

With a rule union within the broadcast bound this is a single scan, a single
BroadcastHashJoin and no shuffle before the write; beyond it still one scan and one
join, salted (see ``sized_join``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelforge.operators.profile import KEY
from labelforge.operators.ranges import (AXIS_POINTS, Axis, axis_of, block_column, levels_of, range_blocks,
                                         range_match)
from labelforge.operators.sizing import (DEFAULT_SALT_BUCKETS, MAX_BROADCAST_BYTES, measured_bytes,
                                        sized_join)
from labelforge.session import written
from labelforge.sources.literal import literal_frame


@dataclass
class MatchSpec:
    tag: str
    value: Column | str
    rules: DataFrame            # rule, name


@dataclass
class RangeSpec:
    tag: str
    value: Column | str
    ranges: DataFrame           # name, start, end
    bounds: str = "closed"


@dataclass
class CopySpec:
    tag: str
    value: Column | str


RULE_SCHEMA = T.StructType([
    T.StructField("tag", T.StringType()), T.StructField("k", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("lo", T.DoubleType()),
    T.StructField("hi", T.DoubleType()), T.StructField("name", T.StringType())])


def _col(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def _range_side(s: "RangeSpec", axis_points: int) -> tuple[DataFrame, Axis | None]:
    """A model's ranges by block, and their axis; without one if it has too many end points."""
    r = s.ranges.select(F.col("name"), F.col("start").cast("double").alias("_s"),
                        F.col("end").cast("double").alias("_e")) \
        .where((F.col("_s") <= F.col("_e")) & ~F.isnan("_s") & ~F.isnan("_e"))
    axis = axis_of(r, axis_points)
    if axis is None:
        return r, None
    blocks = range_blocks(r, axis)
    axis.levels = levels_of(blocks)
    return blocks, axis


@dataclass
class RuleSide:
    """Rules of several models in one frame, the axes of the range models, and its size:
    everything that does not depend on the business rows.  A range model without an axis is
    matched by itself."""

    rules: DataFrame
    axes: dict
    size: int


def combined_rules(spark: SparkSession, specs: list, axis_points: int = AXIS_POINTS) -> tuple[DataFrame, dict]:
    """Union of every model's rules as ``(tag, k, kind, lo, hi, name)``, and the axis of each
    range model (None for those with too many end points, which are left out)."""
    parts, axes = [spark.createDataFrame([], RULE_SCHEMA)], {}
    for s in specs:
        if isinstance(s, MatchSpec):
            parts.append(s.rules.select(F.lit(s.tag).alias("tag"), F.col("rule").cast("string")
                                        .alias("k"), F.lit("match").alias("kind"),
                                        F.lit(None).cast("double").alias("lo"),
                                        F.lit(None).cast("double").alias("hi"), "name"))
        elif isinstance(s, RangeSpec):
            listed, axes[s.tag] = _range_side(s, axis_points)
            if axes[s.tag] is None:
                continue
            parts.append(listed.select(F.lit(s.tag).alias("tag"),
                                       F.col("_b").cast("string").alias("k"),
                                       F.lit(s.bounds).alias("kind"), F.col("_s").alias("lo"),
                                       F.col("_e").alias("hi"), "name"))
        elif isinstance(s, CopySpec):
            parts.append(literal_frame(spark, [(s.tag, "", "copy", None, None, None)],
                                       RULE_SCHEMA))
        else:
            raise TypeError(f"unknown model spec {s!r}")
    return reduce(lambda a, b: a.unionByName(b), parts), axes


def rule_side(spark: SparkSession, specs: list, keep: bool = False, axis_points: int = AXIS_POINTS) -> RuleSide:
    """The rule side of ``specs``; with ``keep`` written to the shared folder, for use over
    many batches of rows."""
    rules, axes = combined_rules(spark, specs, axis_points)
    rules = written(rules, "rules") if keep else rules
    return RuleSide(rules, axes, measured_bytes(rules))


def tag_all(df: DataFrame, key: str, specs: list,
            max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
            salt_buckets: int = DEFAULT_SALT_BUCKETS, side: RuleSide | None = None) -> DataFrame:
    """Evaluate all ``specs`` on ``df`` -> long tags ``(userId, tag, value)``.  ``side``: their
    rule side, where it was built before."""
    spark = df.sparkSession
    side = side or rule_side(spark, specs)

    alone = [s for s in specs if isinstance(s, RangeSpec) and side.axes[s.tag] is None]
    specs = [s for s in specs if s not in alone]
    rows = df
    for k, s in enumerate(specs):
        if isinstance(s, RangeSpec):
            rows = side.axes[s.tag].place(rows.withColumn(f"_x{k}", _col(s.value).try_cast("double")),
                                          f"_x{k}", f"_piece{k}")

    def cell(k, s):
        is_range = isinstance(s, RangeSpec)
        text = F.lit(None).cast("string") if is_range else _col(s.value).cast("string")
        num = F.col(f"_x{k}") if is_range else F.lit(None).cast("double")
        if is_range:
            keys = F.when(F.col(f"_piece{k}").isNotNull(), F.transform(
                block_column(F.col(f"_piece{k}"), side.axes[s.tag].levels), lambda b: b.cast("string")))
        else:
            keys = F.array(text if isinstance(s, MatchSpec) else F.lit(""))
        return F.struct(F.lit(s.tag).alias("tag"), text.alias("s"), num.alias("x"), keys.alias("ks"))

    large = [range_match(df, _col(s.value).try_cast("double"), s.ranges, key, "value", s.bounds, key_alias=KEY,
                         max_broadcast_bytes=max_broadcast_bytes, salt_buckets=salt_buckets, axis_points=0)
             .select(KEY, F.lit(s.tag).alias("tag"), "value").where(F.col("value").isNotNull()) for s in alone]
    if not specs:
        return reduce(lambda a, b: a.unionByName(b), large)
    cells = F.array(*[cell(k, s) for k, s in enumerate(specs)])
    long = rows.select(F.col(key).alias(KEY), F.inline(cells)) \
        .select(KEY, "tag", "s", "x", F.explode("ks").alias("k"))
    rules = side.rules.select(F.col("tag").alias("_rtag"), F.col("k").alias("_rk"), "kind", "lo", "hi", "name")

    def on(left, right):
        x, kind = left["x"], right["kind"]
        return ((left["tag"] == right["_rtag"]) & (left["k"] == right["_rk"])
                & ((kind == "match") | (kind == "copy")
                   | ((kind == "closed") & x.between(right["lo"], right["hi"]))
                   | ((kind == "left_open") & (x > right["lo"]) & (x <= right["hi"]))))

    joined = sized_join(long, rules, on, "inner", [KEY, "tag"], max_broadcast_bytes, side.size, salt_buckets)
    value = F.when(F.col("kind") == "copy", F.col("s")).otherwise(F.col("name"))
    tagged = joined.select(KEY, "tag", value.alias("value")).where(F.col("value").isNotNull())
    return reduce(lambda a, b: a.unionByName(b), [tagged, *large])


@dataclass
class ModeSpec:
    tag: str
    category: str
    rules: DataFrame            # rule, name (matched against the most frequent category)


@dataclass
class RecencySpec:
    tag: str
    time_col: str
    ranges: DataFrame           # name, start, end (closed day ranges)
    as_of: str
    time_kind: str = "timestamp"


def tag_aggregates(df: DataFrame, key: str, mode: ModeSpec | None = None,
                   recency: list[RecencySpec] | None = None,
                   max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Mode and recency models over ONE scan and ONE two-level aggregation.

    ``(key, category)`` -> count and latest time of every recency column (partial
    aggregation before the shuffle), then ``key`` -> most frequent category (ties:
    smallest) and overall latest times, then every tag through ``tag_all``'s single
    broadcast join.  A key holding a third of all rows is cut down map-side in both
    aggregations.  Output: long ``(userId, tag, value)``.
    """
    from labelforge.functions.dates import days_since

    recency = recency or []
    times = []
    for r in recency:
        t = F.col(r.time_col)
        times.append(F.timestamp_seconds(t.try_cast("long")) if r.time_kind == "epoch" else t)
    cat = F.col(mode.category) if mode else F.lit(None).cast("string")
    first = df.groupBy(F.col(key).alias(KEY), cat.alias("_cat")).agg(
        F.count(cat).alias("_n"), *[F.max(t).alias(f"_t{i}") for i, t in enumerate(times)])
    best = F.min(F.when(F.col("_n") > 0, F.struct((-F.col("_n")).alias("n"),
                                                  F.col("_cat").alias("c"))))
    second = first.groupBy(KEY).agg(best.alias("_mode"),
                                    *[F.max(f"_t{i}").alias(f"_t{i}") for i in range(len(times))])
    specs = []
    if mode:
        specs.append(MatchSpec(mode.tag, F.col("_mode.c"), mode.rules))
    for i, r in enumerate(recency):
        specs.append(RangeSpec(r.tag, days_since(F.col(f"_t{i}"), r.as_of), r.ranges, "closed"))
    return tag_all(second, KEY, specs, max_broadcast_bytes)
