"""Entity profile store.

Storage form is LONG: cells ``(userId, value, version)`` in folders by tag and run.  A model's
run only appends, and the store's log (``run_log``) makes it visible when it is complete; a
run that replaces a tag voids that tag's cells of earlier runs (so an empty run clears its
tag), and their folders are no longer read.  Readers take, per (key, tag), the value of the
latest run, and of the greatest ``version`` (an event time, say) inside a run.
``compact_profile`` makes the present state the first run that is read.  The WIDE view (one column per tag) is a pivot of the long
form; both are pure DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelforge.operators.run_log import RUN, RunLog, newest
from labelforge.operators.sizing import sized_join
from labelforge.session import written

KEY = "userId"
SEARCH_OPERATORS = ("eq", "ne", "lt", "le", "gt", "ge", "contains")


def to_long(tagged: DataFrame, key: str = KEY, tags: list[str] | None = None) -> DataFrame:
    """Wide tag frame -> long cells; null values are "no cell" and are dropped."""
    tags = tags or [c for c in tagged.columns if c != key]
    long = tagged.unpivot([key], [F.col(t).cast("string").alias(t) for t in tags], "tag", "value")
    return long.where(F.col("value").isNotNull())


def union_long(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def pivot_long(long: DataFrame, tags: list[str], key: str = KEY) -> DataFrame:
    """Long -> wide; ``tags`` fixes the columns (no extra job to find them)."""
    return long.groupBy(key).pivot("tag", tags).agg(F.max("value"))


def merge_wide(frames: list[DataFrame], key: str = KEY) -> DataFrame:
    """Several tag frames -> one wide profile (union + one shuffle, not a join chain)."""
    tags = [c for f in frames for c in f.columns if c != key]
    return pivot_long(union_long([to_long(f, key) for f in frames]), tags, key)


def latest_cells(long: DataFrame, key: str = KEY) -> DataFrame:
    """One cell per (key, tag): the value with the greatest ``version`` (without that column
    all are equal); of equal ones the greatest text, so that the answer is repeatable."""
    version = F.col("version") if "version" in long.columns else F.lit(0).cast("long")
    best = long.where(F.col("value").isNotNull()).groupBy(key, "tag") \
        .agg(F.max(F.struct(version.alias("version"), "value")).alias("_b"))
    return best.select(key, "tag", F.col("_b.value").alias("value"), F.col("_b.version").alias("version"))


def upsert_long(old: DataFrame, new: DataFrame, key: str = KEY) -> DataFrame:
    """Per (key, tag): the new value if there is one, else the old one.  Keys and
    tags only in ``old`` keep their value (the reference's per-row upsert)."""
    both = latest_cells(old, key).withColumn("_v", F.lit(0)) \
        .unionByName(latest_cells(new, key).withColumn("_v", F.lit(1)))
    best = both.groupBy(key, "tag").agg(F.max_by("value", "_v").alias("value"))
    return best.select(key, "tag", "value")


def upsert_wide(old: DataFrame, new: DataFrame, key: str = KEY) -> DataFrame:
    """A5 on wide frames: columns written by ``new`` change, the others stay.

    One aggregate keyed by entity does both the per-tag "new wins" choice and the
    pivot, so the plan has a single shuffle."""
    tags = list(dict.fromkeys([c for c in old.columns + new.columns if c != key]))
    both = to_long(old, key).withColumn("_v", F.lit(0)) \
        .unionByName(to_long(new, key).withColumn("_v", F.lit(1)))
    return both.groupBy(key).agg(*[
        F.max(F.when(F.col("tag") == t, F.struct("_v", "value"))).getField("value").alias(t)
        for t in tags])


def _file_layout(long: DataFrame, key: str) -> DataFrame:
    """Rebalance by tag (AQE splits a large tag into advisory-size partitions and
    merges small ones, so each tag folder gets a few well-sized files instead of
    one file per task) and sort each file by key (min/max pruning for key lookups)."""
    return long.hint("rebalance", "tag").sortWithinPartitions("tag", key)


def write_profile(long: DataFrame, path: str, mode: str = "replace_tag",
                  key: str = KEY, tags: list[str] | None = None, run: str | int | None = None) -> str:
    """Profile sink: appends the run's cells ``(key, tag, value[, version])`` and returns its name
    in the log.

    ``replace_tag``: the run's cells are all that is left of its tags: those in ``tags`` or,
    without it, those present in ``long``.  ``upsert``: keys missing from this run keep
    their old value.  ``run``: what names the run where it may be repeated (a batch, say): a
    replayed run takes its old place and changes nothing.  Runs at the same time both
    survive, in the order of their claims; none is read before it is complete.
    """
    if mode not in ("replace_tag", "upsert"):
        raise ValueError("mode must be 'replace_tag' or 'upsert'")
    log = RunLog(long.sparkSession, path)
    name = log.claim(run)
    replaced = []
    if mode == "replace_tag":
        # one name per model of the run
        replaced = list(tags) if tags is not None else [r["tag"] for r in long.select("tag").distinct().collect()]
    _append_run(latest_cells(long, key), path, name, key, log)
    log.commit(name, replaced)
    return name


def _append_run(cells: DataFrame, path: str, name: str, key: str, log: RunLog) -> None:
    out = cells.select(key, "value", F.col("version").cast("long").alias("version"), "tag", F.lit(name).alias(RUN))
    log.save_schema(out.schema)
    # a replayed run that had failed half-way writes its folders anew
    _file_layout(out, key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("tag", RUN).parquet(path)


def _stored(spark: SparkSession, path: str, tags: list[str] | None) -> DataFrame:
    """The visible cells of all runs: only the folders of ``tags`` and of the runs that count."""
    log = RunLog(spark, path)
    runs = log.runs()
    df = spark.read.schema(log.schema()).parquet(path).where(runs.visible())
    return df.where(F.col("tag").isin(tags)) if tags else df


def read_profile(spark: SparkSession, path: str, tags: list[str] | None = None,
                 key: str = KEY) -> DataFrame:
    """Long profile as of now; a tag list prunes folders at the scan."""
    return newest(_stored(spark, path, tags), key)


def compact_profile(spark: SparkSession, path: str, tags: list[str] | None = None, key: str = KEY) -> str:
    """Writes the present state of ``tags`` (all without it) as one run that voids those before it:
    readers then open its folders and those of later runs only.  Reads what earlier
    compactions left, not all history.  Refuses while a run before it is not complete."""
    log = RunLog(spark, path)
    name = log.claim(first=True)
    before = log.runs()
    pending = [r for r in before.open if r < name]
    if pending:
        log.forget([name])
        raise RuntimeError(f"runs are not complete: {', '.join(pending)}")
    stored = _stored(spark, path, tags).where(F.col(RUN) < name)
    tags = tags if tags is not None else [r["tag"] for r in stored.select("tag").distinct().collect()]
    _append_run(newest(stored, key).withColumn("version", F.lit(0).cast("long")), path, name, key, log)
    after = log.runs()
    if {r for r in after.committed + after.open if r < name} - set(before.committed):
        raise RuntimeError("a run claimed an earlier place meanwhile: compact again")
    log.commit(name, tags)
    return name


def vacuum_profile(spark: SparkSession, path: str) -> list[str]:
    """Deletes the folders of runs that a later one voids, and such runs from the log; for times
    when nothing reads an earlier state.  Returns what was deleted."""
    log = RunLog(spark, path)
    runs = log.runs()
    gone = [f"tag={tag}/{RUN}={run}" for tag, base in runs.base.items() for run in runs.committed if run < base]
    deleted = [x for x in gone if log.delete_data(path, x)]
    kept = set(runs.base.values())
    log.forget([r for r in runs.committed if r not in kept and not log.has_data(path, f"*/{RUN}={r}")])
    return deleted


def packed_tags(df: DataFrame, key: str, packed: str, pair_sep: str = ",",
                kv_sep: str = ":", key_cell: str | None = None) -> DataFrame:
    """``"gender:x,job:y"`` -> long cells ``(key, tag, value)``.

    Same parser as the rule text (H1): trimmed, split on the first ``kv_sep``, a
    repeated tag keeps its last value, a pair without ``kv_sep`` raises.  ``key_cell``
    also stores the key itself as a cell of that name.
    """
    from labelforge.functions.rules import parse_kv_rule
    m = parse_kv_rule(F.col(packed), pair_sep, kv_sep)
    if key_cell:
        m = F.map_concat(F.map_filter(m, lambda k, _: k != key_cell),
                         F.create_map(F.lit(key_cell), F.col(key).cast("string")))
    return df.select(F.col(key).alias(KEY), F.explode(m).alias("tag", "value"))


def search_predicate(column: str, method: str, value) -> Column:
    c = F.col(column)
    v = F.lit(value)
    ops = {"eq": lambda: c == v, "ne": lambda: c != v, "lt": lambda: c < v,
           "le": lambda: c <= v, "gt": lambda: c > v, "ge": lambda: c >= v,
           "contains": lambda: c.contains(v)}
    if method not in ops:
        raise ValueError(f"method must be one of {SEARCH_OPERATORS}")
    return ops[method]()


def search(profile: DataFrame, column: str, method: str, value,
           columns: list[str] | None = None) -> DataFrame:
    """Rows of the wide profile where ``column <method> value``."""
    out = profile.where(search_predicate(column, method, value))
    return out.select(*columns) if columns else out


def search_cells(cells: DataFrame, column: str, method: str, value, columns: list[str],
                 key: str = KEY) -> DataFrame:
    """B8/M19 on long cells ``(key, tag, value)``: the wide rows of ``columns`` where ``column
    <method> value``, without a wide view of everybody.

    The predicate is evaluated on its own tag's cells.  The other tags' cells are cut down to the
    keys that match before they are shuffled (by a broadcast of the keys if they are few, see
    ``sized_join``), and only those become columns."""
    own = cells.where(F.col("tag") == column).select(key, F.col("value").alias(column))
    hits = own.where(search_predicate(column, method, value))
    others = [c for c in columns if c not in (key, column)]
    if not others:
        return hits.select(*columns)
    hits = written(hits, "search-hits")
    named = hits.select(F.col(key).alias("_hit")).distinct()
    rest = sized_join(cells.where(F.col("tag").isin(others)), named, lambda a, b: a[key] == b["_hit"], "inner",
                      [key, "tag"]).select(key, "tag", "value")
    wide = rest.groupBy(key).agg(*[F.max(F.when(F.col("tag") == t, F.col("value"))).alias(t) for t in others])
    return hits.join(wide, key, "left").select(*columns)


def search_profile(spark: SparkSession, path: str, column: str, method: str, value, columns: list[str],
                   key: str = KEY) -> DataFrame:
    """``search_cells`` on the store at ``path``: of the folders, those of the tags in use are read."""
    tags = list(dict.fromkeys(c for c in [column, *columns] if c != key))
    return search_cells(read_profile(spark, path, tags, key), column, method, value, columns, key)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with a header.  ``single_file`` funnels everything through one task
    (the reference's ``coalesce(1)``) and is only for small results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path
