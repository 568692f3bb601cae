"""Rule matching (C1, C2, D6) and copy tags (B1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelforge.operators.sizing import DEFAULT_SALT_BUCKETS, MAX_BROADCAST_BYTES, sized_join

UNMATCHED_POLICIES = ("drop", "null", "default", "error")


def dedup_rules(rules: DataFrame, rule_col: str = "rule", name_col: str = "name",
                order_col: str = "id") -> DataFrame:
    """One name per rule value, the row with the greatest ``order_col`` wins
    (the map form's "last duplicate wins"), kept distributed as a DataFrame."""
    return rules.groupBy(rule_col).agg(F.max_by(name_col, order_col).alias(name_col))


def rule_match(df: DataFrame, field, rules: DataFrame, key: str = "id",
               tag: str = "tag", on_unmatched: str = "drop", default: str | None = None,
               dedup: bool = False, rule_col: str = "rule", name_col: str = "name",
               order_col: str = "id", key_alias: str = "userId",
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
               salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Tag each row whose ``field`` equals a rule value with the rule's name.

    Both sides are compared as text: the number 1 equals the rule ``1`` and not ``01``.
    Output ``(userId, <tag>)``.  ``on_unmatched``: ``drop`` (inner join; a null or
    unknown value gives no row), ``null``, ``default`` (fill ``default``) or ``error``
    (fail the job on the first unmatched value, like a strict map lookup).
    Duplicate rule values fan out unless ``dedup`` keeps the one with the greatest
    ``order_col``.  For the join see ``sized_join``.
    """
    if on_unmatched not in UNMATCHED_POLICIES:
        raise ValueError(f"on_unmatched must be one of {UNMATCHED_POLICIES}")
    value: Column = F.col(field) if isinstance(field, str) else field
    r = dedup_rules(rules, rule_col, name_col, order_col) if dedup else rules
    r = r.select(F.col(rule_col).cast("string").alias("_rule"), F.col(name_col).alias("_name"))
    left = df.select(F.col(key).alias(key_alias), value.cast("string").alias("_value"))
    joined = sized_join(left, r, lambda a, b: a["_value"] == b["_rule"],
                        "inner" if on_unmatched == "drop" else "left", [key_alias],
                        max_broadcast_bytes, salt_buckets=salt_buckets)
    name = F.col("_name")
    if on_unmatched == "default":
        name = F.coalesce(name, F.lit(default))
    elif on_unmatched == "error":
        name = F.when(name.isNull(), F.raise_error(F.concat(
            F.lit("no rule for value: "), F.coalesce(F.col("_value").cast("string"),
                                                     F.lit("null")))).cast("string")).otherwise(name)
    return joined.select(key_alias, name.alias(tag))


def copy_tag(df: DataFrame, field: str, key: str = "id", tag: str | None = None,
             key_alias: str = "userId") -> DataFrame:
    """B1: the field's own value is the tag (company name, symbol)."""
    return df.select(F.col(key).alias(key_alias), F.col(field).alias(tag or field))
