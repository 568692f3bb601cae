"""Tag models (M1-M11): catalog -> rules -> business data -> tag operator -> profile.

``execute`` mirrors one model run: load the tag's rules from the catalog (A1),
parse the level-4 rule text (the only value brought to the driver, H1), read the
business data it names (A6 with A2-A4), tag it, and optionally save the result
into the long profile (A5).  Failures propagate (nothing is swallowed).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelforge.functions.dates import date_text_to_int
from labelforge.functions.rules import parse_range
from labelforge.operators import aggregates, profile
from labelforge.operators.match import copy_tag, rule_match
from labelforge.operators.mode import mode_category
from labelforge.operators.ranges import range_match
from labelforge.operators.recency import recency_tag
from labelforge.sources.catalog import load_tag_rules, model_rule_text, value_rules
from labelforge.sources.wide import business_data, rule_map


@dataclass
class ModelInputs:
    meta: dict              # parsed level-4 rule
    business: DataFrame     # STRING columns named by selectFieldNames
    values: DataFrame       # level-5 rows: id, name, rule, level


def model_inputs(spark: SparkSession, tags: DataFrame, tag_id: int,
                 as_of: str | None = None, missing: str = "drop") -> ModelInputs:
    rules = load_tag_rules(tags, tag_id, ordered=False)
    meta = rule_map(model_rule_text(rules))
    return ModelInputs(meta, business_data(spark, meta, as_of, missing), value_rules(rules))


def _ranges(values: DataFrame, sep: str, kind: str) -> DataFrame:
    r = values.select("name", parse_range(F.col("rule"), sep, kind).alias("r"))
    return r.select("name", F.col("r.start").alias("start"), F.col("r.end").alias("end"))


def match_model(inp: ModelInputs, field: str, tag: str, key: str = "id",
                on_unmatched: str = "drop", default: str | None = None) -> DataFrame:
    """M1-M4, M8: exact rule match (duplicate rules: greatest tag id wins)."""
    return rule_match(inp.business, field, inp.values, key=key, tag=tag,
                      on_unmatched=on_unmatched, default=default, dedup=True)


def copy_model(inp: ModelInputs, field: str, tag: str | None = None, key: str = "id") -> DataFrame:
    """The field itself is the tag."""
    return copy_tag(inp.business, field, key=key, tag=tag)


def date_range_model(inp: ModelInputs, field: str, tag: str, key: str = "id") -> DataFrame:
    """M5: ``yyyy-MM-dd`` text -> yyyyMMdd int, tagged by closed ``start-end`` rules."""
    return range_match(inp.business, date_text_to_int(F.col(field)),
                       _ranges(inp.values, "-", "int"), key=key, tag=tag, bounds="closed")


def ratio_range_model(inp: ModelInputs, field: str, tag: str, key: str = "id") -> DataFrame:
    """Double value tagged by left-open ``start~end`` rules."""
    return range_match(inp.business, F.col(field).try_cast("double"),
                       _ranges(inp.values, "~", "double"), key=key, tag=tag,
                       bounds="left_open")


def recency_model(inp: ModelInputs, key: str, time_field: str, tag: str, as_of: str,
                  time_kind: str = "epoch") -> DataFrame:
    """M6: days since the latest event per key, tagged by closed day ranges."""
    return recency_tag(inp.business, key, time_field, _ranges(inp.values, "-", "int"), as_of,
                       tag=tag, time_kind=time_kind)


def mode_model(inp: ModelInputs, key: str, category: str, tag: str) -> DataFrame:
    """M7: most frequent category per key, then matched against the value rules."""
    mode = mode_category(inp.business, key, category, out="_mode")
    return rule_match(mode, "_mode", inp.values, key="userId", tag=tag, dedup=True)


def distribution(tagged: DataFrame, tag: str) -> DataFrame:
    """M8 report: rows per tag value."""
    return aggregates.tag_distribution(tagged, tag)


def save(tagged: DataFrame, profile_path: str | None = None, mode: str = "upsert",
         table: str | None = None) -> None:
    """A5: write the model's tag column(s) into the long profile store: a Parquet
    path (``profile_path``) or a bucketed profile table (``table``)."""
    tags = [c for c in tagged.columns if c != profile.KEY]
    long = profile.to_long(tagged)
    if table is not None:
        from labelforge.operators import profile_table
        write = profile_table.upsert_tags if mode == "upsert" else profile_table.replace_tags
        write(long, table, tags)
        return
    profile.write_profile(long, profile_path, mode=mode, tags=tags)


MODEL_KINDS = {"match": match_model, "copy": copy_model, "date_range": date_range_model,
               "ratio_range": ratio_range_model, "recency": recency_model, "mode": mode_model}


def execute(spark: SparkSession, tags: DataFrame, tag_id: int, kind: str,
            profile_path: str | None = None, as_of: str | None = None,
            save_mode: str = "upsert", **params) -> DataFrame:
    """One model run: rules of ``tag_id`` -> business data -> ``kind`` operator ->
    optional save into the profile at ``profile_path``.  Returns the tag frame."""
    if kind not in MODEL_KINDS:
        raise ValueError(f"kind must be one of {sorted(MODEL_KINDS)}")
    inp = model_inputs(spark, tags, tag_id, as_of)
    if kind == "recency":
        params.setdefault("as_of", as_of)
    tagged = MODEL_KINDS[kind](inp, **params)
    if profile_path:
        save(tagged, profile_path, save_mode)
    return tagged
