"""Tag catalog access.

The catalog is a DataFrame ``id long, pid long, level int, name string, rule string``:
a tree by ``pid`` where a level-4 row names a business data source and its level-5
children hold the value rules.  It is small, but every operation stays a DataFrame
operation; only the single level-4 rule string is ever brought to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelforge.operators.ordering import global_rank
from labelforge.operators.sizing import sized_join
from labelforge.session import written

CATALOG_COLUMNS = ("id", "pid", "level", "name", "rule")


def load_tag_rules(tags: DataFrame, tag_id: int, ordered: bool = True) -> DataFrame:
    """A1/G1/F1: the tag row UNION (distinct) its children -> id, name, rule, level."""
    cols = ["id", "name", "rule", "level"]
    me = tags.where(F.col("id") == tag_id).select(*cols)
    kids = tags.where(F.col("pid") == tag_id).select(*cols)
    out = me.union(kids).distinct()
    return out.orderBy("level", "id") if ordered else out


def model_rule_text(rules: DataFrame) -> str:
    """the level-4 row's rule text (error when there is none)."""
    row = rules.where(F.col("level") == 4).orderBy("id").select("rule").limit(1).collect()
    if not row:
        raise ValueError("no level-4 tag in the rule set")
    return row[0]["rule"]


def value_rules(rules: DataFrame) -> DataFrame:
    """B2: the level-5 rows (value rules)."""
    return rules.where(F.col("level") == 5)


def tag_children(tags: DataFrame, pid: int) -> DataFrame:
    """Children of a tag."""
    return tags.where(F.col("pid") == pid)


def list_tags(tags: DataFrame, level: int | None = None, pid: int | None = None) -> DataFrame:
    """By level and/or parent; both -> AND, neither -> all."""
    out = tags
    if level is not None:
        out = out.where(F.col("level") == level)
    if pid is not None:
        out = out.where(F.col("pid") == pid)
    return out


def find_tag(tags: DataFrame, name: str, level: int, pid: int) -> DataFrame:
    """Exact (name, level, pid) lookup."""
    return tags.where((F.col("name") == name) & (F.col("level") == level) & (F.col("pid") == pid))


def tags_with_models(tags: DataFrame, models: DataFrame, tag_key: str = "id",
                     model_key: str = "tag_id") -> DataFrame:
    """Every tag with its model row, or nulls (one left join, see ``sized_join``)."""
    named = models.withColumnRenamed(model_key, "_model_key")
    joined = sized_join(tags, named, lambda a, b: a[tag_key] == b["_model_key"], "left", [tag_key])
    drop = {"_salt", "_rsalt", "_model_key"}
    key = [] if model_key in tags.columns else [F.col("_model_key").alias(model_key)]
    return joined.select(*[c for c in joined.columns if c not in drop], *key)


def insert_if_absent(old: DataFrame, new: DataFrame,
                     keys=("name", "level", "pid")) -> DataFrame:
    """C6 (flat): rows of ``new`` whose keys are not in ``old``, appended to ``old``.  Null
    keys equal null keys; of several new rows under one key the smallest is inserted (by its
    columns in their order, nulls first)."""
    keys = list(keys)
    one = new.groupBy(*keys).agg(F.min(F.struct(*new.columns)).alias("_row")).select("_row.*")
    have = old.select(*[F.col(k).alias(f"_old_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [one[k].eqNullSafe(have[f"_old_{k}"]) for k in keys])
    missing = one.join(have, same, "left_anti")
    return old.unionByName(missing, allowMissingColumns=True)


def catalog_paths(tags: DataFrame) -> DataFrame:
    """(path, id) of the rows that hang together from the root (pid -1) down, a level each; of
    several rows with one path the smallest id."""
    spark = tags.sparkSession
    walk = spark.sql(
        "WITH RECURSIVE walk (id, level, path) AS ("
        " SELECT id, level, array(name) FROM {tags} WHERE pid = -1 AND level = 1 UNION ALL"
        " SELECT t.id, t.level, concat(walk.path, array(t.name)) FROM {tags} t"
        " JOIN walk ON t.pid = walk.id AND t.level = walk.level + 1)"
        " SELECT path, id FROM walk", tags=tags.select("id", "pid", "level", "name"))
    return walk.groupBy("path").agg(F.min("id").alias("id"))


def insert_tag_paths(old: DataFrame, paths: DataFrame, max_level: int | None = None) -> DataFrame:
    """``paths`` holds one row per tag path with columns ``l1``, ``l2``, ... (names; null
    ends a shorter path), of any depth or down to ``max_level``.

    Every beginning of a path is a key of its own.  Those the catalog lacks get fresh ids (max
    id + rank by level, then path) in one pass for all levels, and each takes as ``pid`` the id
    of the beginning one shorter, old or fresh; the root's pid is -1.
    """
    levels = sorted((int(c[1:]) for c in paths.columns if c[:1] == "l" and c[1:].isdigit()))
    levels = [k for k in levels if max_level is None or k <= max_level]
    names = F.array(*[F.col(f"l{k}") for k in levels])
    depth = F.array_position(F.transform(names, lambda x: x.isNull()), True) - 1
    whole = paths.select(F.slice(names, 1, F.when(depth < 0, len(levels)).otherwise(depth).cast("int")).alias("p"))
    wanted = whole.where(F.size("p") > 0) \
        .select(F.explode(F.transform(F.sequence(F.lit(1), F.size("p")), lambda k: F.slice("p", 1, k))).alias("path")) \
        .distinct()
    cat = old.select(*CATALOG_COLUMNS)
    have = written(catalog_paths(cat), "catalog-paths")
    absent = wanted.join(have, "path", "left_anti").withColumn("level", F.size("path"))
    ranked = global_rank(absent, ["level", "path"], "_pos")
    base = cat.agg(F.coalesce(F.max("id"), F.lit(0)).alias("n")).first()["n"]
    fresh = written(ranked.select("path", "level", (F.lit(base) + F.col("_pos")).cast("long").alias("id")), "fresh-tags")
    above = have.unionByName(fresh.select("path", "id")).select(F.col("path").alias("_above"), F.col("id").alias("pid"))
    beginning = F.slice("path", 1, F.col("level") - 1)
    rows = fresh.join(above, beginning == F.col("_above"), "left") \
        .select("id", F.coalesce("pid", F.lit(-1).cast("long")).alias("pid"), "level",
                F.element_at("path", -1).alias("name"), F.lit(None).cast("string").alias("rule"))
    return cat.unionByName(rows)
