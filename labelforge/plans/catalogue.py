"""Query catalogue on the driver's tables.

Every entry is ``fn(spark, root) -> DataFrame`` and reads the given Parquet
tables (customers and orders play the members and orders of the tagging
domain; region and nation form the tag tree).  Rule sets are literal frames, as
a tag catalog would hold them.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelforge.functions import dates, scores
from labelforge.functions.casts import cast_all_double, positional_columns
from labelforge.functions.rules import parse_kv_rule, parse_range
from labelforge.operators import aggregates, learning, profile
from labelforge.operators.match import copy_tag, rule_match
from labelforge.operators.mode import mode_category
from labelforge.operators.ordering import global_rank, order_check
from labelforge.operators.ranges import range_match
from labelforge.operators.recency import recency_tag
from labelforge.operators.replace import replace_not_in, replace_out_of_range
from labelforge.operators.topk import top_n_per_group, top_n_per_group_sql
from labelforge.session import fresh_path, written
from labelforge.sources import catalog, cells
from labelforge.sources.delimited import parse_cells, parse_delimited_lines, read_csv
from labelforge.sources.literal import literal_frame
from labelforge.sources.tables import append_parquet, read_table
from labelforge.sources.wide import business_data, filter_conditions, read_wide, read_wide_window

# ---------------------------------------------------------------------------
# Fixed rule sets of the catalogue (literal level-5 rules).
SEGMENT_RULES = [("BUILDING", "builder"), ("FURNITURE", "home"), ("HOUSEHOLD", "home2"),
                 ("MACHINERY", "industry")]
ERA_RULES = [("y95", "19950101-19951231"), ("y96-97", "19960101-19971231"),
             ("y98-01", "19980101-20011231")]
ACCT_RULES = [("debt", "-1000.0~0.0"), ("mid", "0.0~5000.0"), ("rich", "5000.0~10000.0")]
ACCT_RULES_NEW = [("mid", "0.0~5000.0"), ("rich", "5000.0~10000.0")]
CYCLE_RULES = [("d0-30", "0-30"), ("d31-90", "31-90"), ("d91-180", "91-180")]
PRIORITY_RULES = [("1-URGENT", "urgent"), ("2-HIGH", "high"), ("5-LOW", "low")]
STATUS_NAMES = {"F": "finished", "O": "open", "P": "pending"}
PRIORITY_SCALE = {"1-URGENT": 1.0, "2-HIGH": 0.8, "3-MEDIUM": 0.7, "4-NOT SPECIFIED": 0.5,
                  "5-LOW": 0.5}
AS_OF_RECENCY = "2001-08-02"
AS_OF_WINDOW = "2001-08-01"
AS_OF_BOUNDS = "2019-09-01"
# ---------------------------------------------------------------------------


def _t(spark: SparkSession, root: str, name: str, cols=None) -> DataFrame:
    return read_table(spark, root, name, cols)


def _rules(spark: SparkSession, rows, names=("rule", "name")) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return literal_frame(spark, rows, schema)


def _range_rules(spark: SparkSession, rows, sep: str, kind: str) -> DataFrame:
    """Range rule texts parsed with H2/H3 -> (name, start, end)."""
    r = literal_frame(spark, rows, "name string, rule string") \
        .select("name", parse_range(F.col("rule"), sep, kind).alias("r"))
    return r.select("name", F.col("r.start").alias("start"), F.col("r.end").alias("end"))


# ------------------------------------------------------------------ catalog
def tag_tree(spark: SparkSession, root: str) -> DataFrame:
    """Regions as level-4 tags (source rule text) and nations as their level-5 values."""
    region = _t(spark, root, "region", ["r_regionkey", "r_name"])
    nation = _t(spark, root, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    l4 = region.select(
        F.col("r_regionkey").cast("long").alias("id"), F.lit(-1).cast("long").alias("pid"),
        F.lit(4).alias("level"), F.col("r_name").alias("name"),
        F.concat_ws("\n", F.lit("inType=parquet"),
                    F.lit("path=" + os.path.join(root, "customer.parquet")),
                    F.lit("selectFieldNames=c_custkey,c_nationkey")).alias("rule"))
    l5 = nation.select(
        (F.lit(100) + F.col("n_nationkey")).cast("long").alias("id"),
        F.col("n_regionkey").cast("long").alias("pid"), F.lit(5).alias("level"),
        F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("rule"))
    return l4.unionByName(l5)


def q_tag_rules_for(spark, root):
    return catalog.load_tag_rules(tag_tree(spark, root), 2, ordered=True) \
        .select("id", "name", "level")


def q_tag_children(spark, root):
    return catalog.tag_children(tag_tree(spark, root), 3).select("id", "pid", "name", "level")


def q_tag_model_left_join(spark, root):
    cust = _t(spark, root, "customer", ["c_nationkey"])
    models = cust.groupBy((F.lit(100) + F.col("c_nationkey")).cast("long").alias("tag_id")) \
        .agg(F.count(F.lit(1)).alias("cnt"))
    return catalog.tags_with_models(tag_tree(spark, root), models).select("id", "name", "cnt")


def q_tag_insert_if_absent(spark, root):
    old = tag_tree(spark, root).select("name", "level", "pid")
    new = literal_frame(spark, [("CHINA_X", 5, 2), ("AFRICA", 4, -1)],
                        "name string, level int, pid long")
    return catalog.insert_if_absent(old, new)


def q_tag_level_lookup(spark, root):
    tree = tag_tree(spark, root)
    by_level = catalog.list_tags(tree, level=5, pid=2)
    exact = catalog.find_tag(tree, "ASIA", 4, -1)
    return by_level.unionByName(exact).select("id", "pid", "name", "level")


def q_tag_path_insert(spark, root):
    region = _t(spark, root, "region", ["r_regionkey", "r_name"])
    nation = _t(spark, root, "nation", ["n_name", "n_regionkey"])
    paths = nation.join(region, nation.n_regionkey == region.r_regionkey) \
        .select(F.col("r_name").alias("l1"), F.col("n_name").alias("l2"))
    empty = literal_frame(spark, [], "id long, pid long, level int, name string, rule string")
    return catalog.insert_tag_paths(empty, paths, max_level=2).select("id", "pid", "level", "name")


# ------------------------------------------------------------------ rules text
def q_rule_kv_parse(spark, root):
    ev = _t(spark, root, "events", ["event_id", "event_type", "user_id"])
    # a rule text per row; "kind" is given twice so the last value must win
    text = F.concat_ws("\n", F.lit("kind = unknown"),
                       F.concat(F.lit(" usr= "), F.col("user_id").cast("string"), F.lit(" ")),
                       F.concat(F.lit("kind="), F.col("event_type")), F.lit(""))
    parsed = ev.select("event_id", parse_kv_rule(text).alias("rule"))
    return parsed.select("event_id", F.col("rule")["kind"].alias("kind"),
                         F.col("rule")["usr"].alias("usr"))


def q_range_rule_parse(spark, root):
    nat = _t(spark, root, "nation", ["n_nationkey"])
    text_i = F.concat((F.col("n_nationkey") * 10).cast("string"), F.lit("-"),
                      (F.col("n_nationkey") * 10 + 9).cast("string"))
    text_d = F.concat(F.lit("-"), F.col("n_nationkey").cast("string"), F.lit(".5~"),
                      F.col("n_nationkey").cast("string"), F.lit(".25"))
    ri, rd = parse_range(text_i, "-", "int"), parse_range(text_d, "~", "double")
    return nat.select("n_nationkey", ri["start"].alias("lo"), ri["end"].alias("hi"),
                      rd["start"].alias("dlo"), rd["end"].alias("dhi"))


def q_rule_text_edges(spark, root):
    """Carriage returns and tabs around rule texts, bounds with signs, malformed
    ranges (dropped on demand), and numbers that match rules as text only."""
    nat = _t(spark, root, "nation", ["n_nationkey", "n_name"])
    n = F.col("n_nationkey").cast("string")
    text = F.concat(F.lit("inType=x\r\n\tfam =\t"), F.col("n_name"), F.lit("\r\n"))
    rule = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("-"), n, F.lit("-\t5\r"))) \
        .when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit(" -9--"), n)).otherwise(F.concat(n, F.lit("-")))
    kv, r = parse_kv_rule(text), parse_range(rule, "-", "int", on_bad_rule="drop")
    named = rule_match(nat, "n_nationkey", _rules(spark, [("1", "one"), ("02", "two"), ("x", "ex")]),
                       key="n_nationkey", tag="named", on_unmatched="null")
    parsed = nat.select("n_nationkey", kv["inType"].alias("kind"), kv["fam"].alias("fam"),
                        r["start"].alias("lo"), r["end"].alias("hi"))
    return parsed.join(named, parsed["n_nationkey"] == named["userId"]).drop("userId")


# ------------------------------------------------------------------ wide reads
def q_wide_read_conditions(spark, root):
    src = spark.read.parquet(os.path.join(root, "orders.parquet"))
    df = read_wide(src, ["o_orderkey", "o_orderstatus"],
                   "o_orderdate[GE]1997-01-01,o_orderdate[le]1997-03-31,o_orderstatus[NE]F")
    return df.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("st"))


def q_wide_read_union_schema(spark, root):
    """A folder whose files have different columns, one of them with two types, read by rule."""
    orders = _t(spark, root, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    path = fresh_path(spark, "wide-folder")
    status = F.col("o_orderstatus")
    orders.where(status == "F").select("o_orderkey", "o_orderstatus").write.parquet(path)
    orders.where(status == "O").select("o_orderkey", "o_custkey").write.mode("append").parquet(path)
    orders.where(status == "P").select("o_orderkey", F.concat(F.lit("c"), "o_custkey").alias("o_custkey")) \
        .write.mode("append").parquet(path)
    meta = {"inType": "parquet", "path": path, "selectFieldNames": "o_orderkey,o_orderstatus,o_custkey",
            "filterConditions": "o_orderkey[NE]1"}
    return business_data(spark, meta).select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("st"),
                                             F.col("o_custkey").alias("cust"))


def q_wide_read_relative_window(spark, root):
    src = spark.read.parquet(os.path.join(root, "orders.parquet"))
    return read_wide_window(src, ["o_orderkey"], "o_orderdate#month#1", AS_OF_WINDOW) \
        .select(F.col("o_orderkey").alias("id"))


def q_filtered_count(spark, root):
    src = spark.read.parquet(os.path.join(root, "orders.parquet"))
    return aggregates.count_rows(read_wide(src, ["o_orderkey"], "o_orderdate[lt]1996-09-01"))


def q_row_get(spark, root):
    return filter_conditions(spark.read.parquet(os.path.join(root, "customer.parquet")),
                             "c_custkey[EQ]42")


# ------------------------------------------------------------------ tag operators
def _segment(spark, root, how="drop", default=None):
    cust = _t(spark, root, "customer", ["c_custkey", "c_mktsegment"])
    return rule_match(cust, "c_mktsegment", _rules(spark, SEGMENT_RULES), key="c_custkey",
                      tag="segment", on_unmatched=how, default=default)


def _acct(spark, root, rules=ACCT_RULES):
    cust = _t(spark, root, "customer", ["c_custkey", "c_acctbal"])
    return range_match(cust, "c_acctbal", _range_rules(spark, rules, "~", "double"),
                       key="c_custkey", tag="acct", bounds="left_open")


def q_rule_match_inner(spark, root):
    return _segment(spark, root)


def q_rule_match_lookup(spark, root):
    return _segment(spark, root, "default", "other")


def q_copy_tag(spark, root):
    return copy_tag(_t(spark, root, "customer", ["c_custkey", "c_name"]), "c_name",
                    key="c_custkey", tag="name")


def q_range_tag_inclusive(spark, root):
    orders = _t(spark, root, "orders", ["o_orderkey", "o_orderdate"])
    return range_match(orders, dates.date_to_int("o_orderdate"),
                       _range_rules(spark, ERA_RULES, "-", "int"), key="o_orderkey",
                       tag="era", bounds="closed")


def q_range_tag_half_open(spark, root):
    return _acct(spark, root)


def q_recency_tag(spark, root):
    orders = _t(spark, root, "orders", ["o_custkey", "o_orderdate"])
    return recency_tag(orders, "o_custkey", "o_orderdate",
                       _range_rules(spark, CYCLE_RULES, "-", "int"), AS_OF_RECENCY,
                       tag="cycle")


def q_recency_tag_epoch(spark, root):
    """Same tag from finish times stored as epoch-second TEXT (compared as numbers)."""
    orders = _t(spark, root, "orders", ["o_custkey", "o_orderdate"]) \
        .select("o_custkey", dates.epoch_day_start(F.col("o_orderdate")).cast("string")
                .alias("finishtime"))
    return recency_tag(orders, "o_custkey", "finishtime",
                       _range_rules(spark, CYCLE_RULES, "-", "int"), AS_OF_RECENCY,
                       tag="cycle", time_kind="epoch")


def q_mode_category(spark, root):
    orders = _t(spark, root, "orders", ["o_custkey", "o_orderpriority"])
    return mode_category(orders, "o_custkey", "o_orderpriority", out="mode")


def q_mode_category_tag(spark, root):
    mode = q_mode_category(spark, root)
    return rule_match(mode, "mode", _rules(spark, PRIORITY_RULES), key="userId",
                      tag="payment")


def q_top1_per_group(spark, root):
    part = _t(spark, root, "part", ["p_brand", "p_partkey", "p_retailprice"])
    return top_n_per_group(part, "p_brand", [("p_retailprice", True), ("p_partkey", False)])


def q_top1_nulls(spark, root):
    """Null values come last in a descending order, a group of nulls keeps one."""
    o = _t(spark, root, "orders", ["o_custkey", "o_orderkey", "o_totalprice"])
    gaps = o.select((F.col("o_custkey") % 700).alias("g"), "o_orderkey",
                    F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("v"))
    return top_n_per_group(gaps, "g", [("v", True), ("o_orderkey", False)])


def q_top3_per_group(spark, root):
    part = _t(spark, root, "part", ["p_brand", "p_partkey", "p_retailprice"])
    return top_n_per_group(part, "p_brand", [("p_retailprice", True), ("p_partkey", False)],
                           n=3, rank_col="rnk")


def q_top1_per_group_sql(spark, root):
    orders = _t(spark, root, "orders", ["o_custkey", "o_orderkey", "o_totalprice"])
    view = "orders_top1_" + uuid.uuid4().hex[:12]  # unique per call
    return top_n_per_group_sql(spark, orders, view, ["o_custkey"],
                               "o_totalprice DESC, o_orderkey",
                               ["o_custkey", "o_orderkey", "o_totalprice"])


def q_tag_distribution(spark, root):
    return aggregates.tag_distribution(_segment(spark, root), "segment")


# ------------------------------------------------------------------ profile store
def q_profile_merge_wide(spark, root):
    return profile.merge_wide([_segment(spark, root), _acct(spark, root)])


def q_profile_upsert(spark, root):
    old = _segment(spark, root).select("userId", F.lit("stale").alias("acct"))
    new = _acct(spark, root, ACCT_RULES_NEW)
    return profile.upsert_wide(old, new)


def q_profile_long_pivot(spark, root):
    path = fresh_path(spark, "profile")
    long = profile.union_long([profile.to_long(_segment(spark, root)),
                               profile.to_long(_acct(spark, root))])
    profile.write_profile(long, path, mode="replace_tag")
    stored = profile.read_profile(spark, path, ["segment", "acct"])
    return profile.pivot_long(stored, ["segment", "acct"])


def q_profile_search(spark, root):
    return profile.search(_acct(spark, root), "acct", "eq", "rich")


def q_kv_tags_explode(spark, root):
    cust = _t(spark, root, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    packed = cust.select("c_custkey", F.concat(F.lit("seg:"), F.col("c_mktsegment"),
                                               F.lit(",nat:"), F.col("c_nationkey").cast("string"))
                         .alias("tags"))
    return profile.packed_tags(packed, "c_custkey", "tags") \
        .select(F.col("userId").alias("id"), "tag", "value")


def q_kv_tags_key_cell(spark, root):
    """A13 with the key stored as a cell of its own."""
    cust = _t(spark, root, "customer", ["c_custkey", "c_mktsegment"])
    packed = cust.select("c_custkey", F.concat(F.lit("seg:"), F.col("c_mktsegment")).alias("tags"))
    return profile.packed_tags(packed, "c_custkey", "tags", key_cell="userId") \
        .select(F.col("userId").alias("id"), "tag", "value")


def q_profile_empty_run(spark, root):
    """A5: a replacing run without rows clears its tag and no other."""
    path = fresh_path(spark, "profile")
    profile.write_profile(profile.to_long(_segment(spark, root)), path)
    profile.write_profile(profile.to_long(_acct(spark, root)), path)
    profile.write_profile(profile.to_long(_segment(spark, root).where("false")), path, tags=["segment"])
    return profile.read_profile(spark, path, ["segment", "acct"])


def q_profile_latest_wins(spark, root):
    """A5: of the values one batch holds for a cell the latest counts, on the first write, on
    an upsert, and after compaction."""
    orders = _t(spark, root, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    cells_ = orders.select(F.col("o_custkey").alias("userId"), F.lit("status").alias("tag"),
                           F.col("o_orderstatus").alias("value"), F.col("o_orderkey").alias("version"))
    path = fresh_path(spark, "profile")
    profile.write_profile(cells_, path, mode="upsert")
    profile.write_profile(cells_.where(F.col("version") % 2 == 0), path, mode="upsert")
    profile.compact_profile(spark, path)
    return profile.read_profile(spark, path)


# ------------------------------------------------------------------ ingest
def order_lines(spark: SparkSession, root: str) -> DataFrame:
    """TSV lines derived from orders: key, status, priority; the priority is empty
    for status 'P' (a trailing empty field) and low-priority rows carry a stray
    fourth field."""
    o = _t(spark, root, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    prio = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderpriority"))
    base = F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), prio)
    line = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(base, F.lit("\tx"))) \
        .otherwise(base)
    return o.select(line.alias("value"))


def q_tsv_ingest_strict(spark, root):
    return parse_delimited_lines(order_lines(spark, root), ["id", "st", "prio"], mode="strict")


def q_tsv_ingest_trim_trailing(spark, root):
    return parse_delimited_lines(order_lines(spark, root), ["id", "st", "prio"],
                                 mode="trim_trailing")


WIDE_FIELDS = 112


def q_tsv_ingest_wide(spark, root):
    """A10 + A11 at the width of the widest load: 112 fields per line, melted into cells."""
    o = _t(spark, root, "orders", ["o_orderkey", "o_custkey"])
    fields = [F.col("o_orderkey").cast("string")] + [
        ((F.col("o_orderkey") * k + F.col("o_custkey")) % 97).cast("string") for k in range(1, WIDE_FIELDS)]
    lines = o.select(F.concat_ws("\t", *fields).alias("value"))
    names = ["id"] + [f"f{k:03d}" for k in range(1, WIDE_FIELDS)]
    melted = parse_cells(lines, names, "id", "detail")
    return melted.groupBy("qualifier").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("long")).alias("total"))


def _nation_wide(spark, root):
    nat = _t(spark, root, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return nat.select("n_nationkey", F.col("n_name").alias("name"),
                      F.col("n_regionkey").alias("region"))


def q_cells_melt(spark, root):
    return cells.melt_cells(_nation_wide(spark, root), "n_nationkey", "detail")


def q_cells_pivot_back(spark, root):
    melted = cells.melt_cells(_nation_wide(spark, root), "n_nationkey", "detail")
    return cells.pivot_cells(melted, ["name", "region"])


def q_cells_sorted_rank(spark, root):
    cust = _t(spark, root, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]) \
        .select(F.col("c_custkey").cast("string").alias("rowkey"), "c_name", "c_mktsegment", "c_acctbal")
    return global_rank(cust, ["rowkey"], "pos")


def q_bulk_load_cells(spark, root):
    """TSV lines -> strict parse -> cells -> key-sorted files -> read back."""
    melted = parse_cells(order_lines(spark, root), ["id", "st", "prio"], "id", "detail")
    path = cells.write_sorted_cells(melted, fresh_path(spark, "cells"))
    return spark.read.parquet(path)


def q_point_get(spark, root):
    """A15 on the key-sorted cell files."""
    cust = _t(spark, root, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    path = cells.write_sorted_cells(cells.melt_cells(cust, "c_custkey", "detail"),
                                    fresh_path(spark, "cells"))
    return cells.get_row(spark, path, "42", "detail")


def q_sorted_order_check(spark, root):
    """Cells of all lineitems, a third of them of one row key, as sorted files that hold
    one unbroken order, the hot row in several of them."""
    li = _t(spark, root, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).otherwise(F.col("l_orderkey").cast("string"))
    cells_ = li.select(hot.alias("rowkey"), F.lit("detail").alias("family"), F.concat_ws(
        "-", "l_orderkey", "l_linenumber").alias("qualifier"), F.col("l_quantity").cast("string").alias("value"))
    path = cells.write_sorted_cells(cells_, fresh_path(spark, "cells"), 16, cut_rows=True)
    files = spark.read.parquet(path).where("rowkey = 'hot'").select("_metadata.file_name").distinct()
    return order_check(spark, path, ["rowkey", "qualifier"]).select("rows", "breaks_inside", "breaks_between") \
        .withColumn("hot_row_cut", F.lit(files.count() > 1))


def q_conditional_replace(spark, root):
    o = _t(spark, root, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    return o.select("o_orderkey",
                    replace_out_of_range("o_custkey", "o_orderkey", 950).alias("member"),
                    replace_not_in("o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"],
                                   "o_orderkey").alias("pay"))


def q_order_cleanup(spark, root):
    """Member ids clamped, payment codes forced into the known list by key hash,
    payment names looked up, finish time moved 350 days to midnight; appended."""
    o = _t(spark, root, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"])
    code = replace_not_in("o_orderpriority", list(scores.PAYMENT_CODES), "o_orderkey")
    cleaned = o.select("o_orderkey",
                       replace_out_of_range("o_custkey", "o_orderkey", 950).alias("member"),
                       code.alias("pay_code"),
                       scores.lookup(code, scores.PAYMENT_NAMES).alias("pay_name"),
                       dates.shift_to_midnight_epoch("o_orderdate", 350).alias("ft"))
    path = fresh_path(spark, "orders-clean")
    append_parquet(cleaned, path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------ scalar functions
def q_code_name_map(spark, root):
    o = _t(spark, root, "orders", ["o_orderkey", "o_orderstatus"])
    return o.select("o_orderkey", scores.lookup("o_orderstatus", STATUS_NAMES).alias("st"))


def q_date_shift_epoch(spark, root):
    o = _t(spark, root, "orders", ["o_orderkey", "o_orderdate"])
    return o.select("o_orderkey", dates.shift_to_midnight_epoch("o_orderdate", 350).alias("ft"))


def q_date_window_bounds(spark, root):
    n = _t(spark, root, "nation", ["n_nationkey"])
    return n.select("n_nationkey",
                    dates.window_start(AS_OF_BOUNDS, "n_nationkey", "month").alias("ago"))


def q_date_text_to_int(spark, root):
    o = _t(spark, root, "orders", ["o_orderkey", "o_orderdate"])
    return o.select("o_orderkey", dates.date_text_to_int(dates.format_date("o_orderdate"))
                    .alias("d"), dates.epoch_to_text(dates.epoch_day_start("o_orderdate"))
                    .alias("txt"))


def q_letter_to_score(spark, root):
    o = _t(spark, root, "orders", ["o_orderkey", "o_orderpriority"])
    return o.select("o_orderkey", scores.letter_to_score("o_orderpriority", PRIORITY_SCALE)
                    .alias("score"))


def q_rating_letter_score(spark, root):
    """H11 with the three fixed rating scales; letters derived from line quantities."""
    li = _t(spark, root, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    letters = F.array(*[F.lit(x) for x in scores.RATING_LETTERS])
    letter = F.try_element_at(letters, (F.pmod(F.col("l_quantity").cast("long"), F.lit(11)) + 1)
                          .cast("int"))  # index 11 -> null: an unknown letter
    return li.select("l_orderkey", "l_linenumber", letter.alias("rating"),
                     scores.letter_to_score(letter, scores.scale(scores.SCALE_ANALYSIS))
                     .alias("s1"),
                     scores.letter_to_score(letter, scores.scale(scores.SCALE_REGRESSION))
                     .alias("s2"),
                     scores.letter_to_score(letter, scores.scale(scores.SCALE_TREE)).alias("s3"))


def q_score_to_letter(spark, root):
    li = _t(spark, root, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    return li.select("l_orderkey", "l_linenumber",
                     scores.score_to_letter("l_quantity").alias("letter"))


def q_cast_features_double(spark, root):
    o = _t(spark, root, "orders", ["o_orderkey", "o_totalprice", "o_orderpriority"])
    df = o.select(F.col("o_orderkey").cast("string").alias("id"),
                  F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("prio"))
    return cast_all_double(df, keep=["id"])


# ------------------------------------------------------------------ analysis
_CORR_COLUMNS = {"qty": "l_quantity", "price": "l_extendedprice", "disc": "l_discount",
                 "tax": "l_tax"}


def q_corr_matrix(spark, root):
    li = _t(spark, root, "lineitem", list(_CORR_COLUMNS.values()))
    return aggregates.corr_matrix(li, _CORR_COLUMNS, pairs="all")


# 25 columns, some with nulls, from whole-number expressions that any SQL engine evaluates alike
WIDE_CORR = {"qty": "l_quantity", "price": "l_extendedprice", "disc": "l_discount", "tax": "l_tax"} | {
    f"m{k}": f"nullif((l_orderkey * {k + 3} + l_partkey * {k % 5 + 1} + l_linenumber) % {k + 7}, {k % 4})"
    for k in range(21)}


def q_corr_matrix_wide(spark, root):
    li = _t(spark, root, "lineitem")
    return aggregates.corr_matrix(li, {n: F.expr(e) for n, e in WIDE_CORR.items()})


def q_positional_features(spark, root):
    """B4 + B7: all columns but the key, by position, cast and summed."""
    part = _t(spark, root, "part", ["p_partkey", "p_size", "p_retailprice"])
    names = positional_columns(part.columns, 1)
    wide = cast_all_double(part, keep=["p_partkey"], columns=names)
    return wide.select("p_partkey", sum(F.col(c) for c in names).alias("total"))


def q_tolerance_flag(spark, root):
    """H13."""
    li = _t(spark, root, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    return li.select("l_orderkey", "l_linenumber",
                     scores.tolerance_flag(F.lit(25.0), "l_quantity", 3.0).alias("flag"))


def q_numeric_summary(spark, root):
    li = _t(spark, root, "lineitem", ["l_quantity", "l_extendedprice", "l_discount"])
    return aggregates.numeric_summary(li, ["l_quantity", "l_extendedprice", "l_discount"])


# ------------------------------------------------------------------ ML
def q_string_index(spark, root):
    o = _t(spark, root, "orders", ["o_orderkey", "o_orderpriority"])
    _, out = learning.index_labels(o, "o_orderpriority", "label")
    return out.select("o_orderkey", "label")


def q_index_to_string(spark, root):
    o = _t(spark, root, "orders", ["o_orderkey", "o_orderpriority"])
    model, out = learning.index_labels(o, "o_orderpriority", "label")
    return learning.restore_labels(out, model.labels, "label", "restored") \
        .select("o_orderkey", "restored")


def q_assemble_max_abs(spark, root):
    li = _t(spark, root, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity",
                                      "l_extendedprice"])
    v = learning.max_abs_scale(learning.assemble(li, ["l_quantity", "l_extendedprice"]))
    arr = learning.vector_elements("features")
    return v.select("l_orderkey", "l_linenumber", F.round(arr[0], 6).alias("f0"),
                    F.round(arr[1], 6).alias("f1"))


def q_l2_normalize(spark, root):
    emb = _t(spark, root, "embeddings", ["vec_id", "embedding"]) \
        .select("vec_id", learning.array_features("embedding").alias("v"))
    out = learning.l2_normalize(emb, "v", "n")
    return out.select("vec_id", F.posexplode(learning.vector_elements("n")).alias("slot", "x")) \
        .select("vec_id", "slot", F.round("x", 4).alias("x"))


def q_vector_index_kinds(spark, root):
    li = _t(spark, root, "lineitem", ["l_linenumber", "l_extendedprice"])
    names = ["linenumber", "price"]
    v = learning.assemble(li, ["l_linenumber", "l_extendedprice"], "fv")
    kinds = learning.vector_category_kinds(v, "fv", 20)
    return literal_frame(spark, [(n, i in kinds) for i, n in enumerate(names)],
                         "f string, categorical boolean")


def q_split_deterministic(spark, root):
    o = _t(spark, root, "orders", ["o_orderkey"])
    return o.groupBy(learning.split_label("o_orderkey", 80).alias("part")) \
        .agg(F.count(F.lit(1)).alias("cnt"))


def q_accuracy(spark, root):
    o = _t(spark, root, "orders", ["o_orderstatus"])
    # majority-class baseline: every order predicted 'F'
    return learning.accuracy(o.withColumn("prediction", F.lit("F")), "o_orderstatus", "prediction")


def q_tolerance_accuracy(spark, root):
    li = _t(spark, root, "lineitem", ["l_quantity"])
    return learning.tolerance_accuracy(li, "l_quantity", F.lit(25.0), 1.0)


def _embedding_frame(spark, root):
    return _t(spark, root, "embeddings", ["vec_id", "embedding", "label"]) \
        .select("vec_id", learning.array_features("embedding").alias("features"),
                F.col("label").cast("double").alias("label"))


# The gradient of a fitted model's loss, against that of the best model without features: the
# given vectors hardly tell their classes apart, so a fit is judged by its loss being least,
# not by how often it is right.
GRADIENT_RATIO = 0.05


def _gradient_small(model, train, features="features", label="label"):
    """One row: whether the fit ends where its loss is least."""
    return learning.optimality(model, train, features, label).select(
        F.lit("train").alias("_split"), (F.col("ratio") <= GRADIENT_RATIO).alias("gradient_small"))


def q_logistic_predict_tag(spark, root):
    """A tag predicted for every row; per split its rows, whether all tags are known
    letters (or none, for scores without one), and for the rows of the fit whether its gradient
    vanishes."""
    data = _embedding_frame(spark, root).withColumn("split", learning.split_label("vec_id", 80))
    train = data.where("split = 'train'")
    model = learning.fit_logistic(train, max_iter=100)
    letter = scores.score_to_letter(F.col("prediction"))
    known = letter.isin([x for _, x in scores.SCORE_LETTERS] + [""])
    out = model.transform(data).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(known).alias("letters_known"))
    return out.join(F.broadcast(_gradient_small(model, train)), F.col("split") == F.col("_split"), "left").drop("_split")


def q_decision_tree_predict(spark, root):
    """A tree of one split on a column that separates its labels: its threshold lies
    between the two quantities next to the border, and it predicts every label."""
    li = _t(spark, root, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"]) \
        .withColumn("size", F.when(F.col("l_quantity") > 25, "large").otherwise("small"))
    fitted = learning.tree_pipeline("size", columns=["l_quantity"], max_categories=2, max_depth=1,
                                    max_bins=64).fit(li)
    tree = fitted.stages[-1]
    threshold = float(re.search(r"<= ([0-9.]+)", tree.toDebugString).group(1))
    out = learning.with_label_restore(fitted).transform(li)
    return out.groupBy("predictedLabel").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("predictedLabel") == F.col("size")).alias("right"),
        F.lit(threshold).alias("threshold"))


def q_model_save_load(spark, root):
    """A model read back predicts what the fitted one does, for every row."""
    from pyspark.ml.classification import LogisticRegressionModel
    data = _embedding_frame(spark, root)
    train, _ = learning.hash_split(data, "vec_id", 80)
    model = learning.fit_logistic(train, max_iter=10)
    path = learning.save_model(model, fresh_path(spark, "model"))
    both = LogisticRegressionModel.load(path).transform(
        model.transform(data).select("vec_id", "features", F.col("prediction").alias("p_fit")))
    return both.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("p_fit") == F.col("prediction")).alias("same"))


# ------------------------------------------------------------------ files and tables
def q_csv_export_import(spark, root):
    nat = _t(spark, root, "nation", ["n_nationkey", "n_name"])
    path = profile.export_csv(nat, fresh_path(spark, "export"))
    schema = T.StructType([T.StructField("n_nationkey", T.IntegerType()),
                           T.StructField("n_name", T.StringType())])
    return read_csv(spark, path, schema, header=True)


def q_table_append(spark, root):
    nat = _t(spark, root, "nation", ["n_nationkey", "n_name"])
    path = fresh_path(spark, "table")
    append_parquet(nat, path)
    append_parquet(nat, path)
    return spark.read.parquet(path)


def q_catalog_table_append(spark, root):
    """A7 + A12: an external catalog table (data under the shared folder) written,
    appended to and read back by name; the catalog entry goes afterwards, the data stay."""
    from labelforge.sources.tables import read_catalog_table
    nat = _t(spark, root, "nation", ["n_nationkey", "n_name"])
    path = fresh_path(spark, "catalog-table")
    name = "nation_copy_" + os.path.basename(path).replace("-", "_")
    try:
        nat.write.option("path", path).saveAsTable(name)
        nat.write.mode("append").option("path", path).saveAsTable(name)
        return written(read_catalog_table(spark, name, ["n_nationkey", "n_name"]), "nation-copy")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def q_profile_table_upsert(spark, root):
    """A5 on a bucketed profile table: the stale profile is written, a new model run
    is upserted (only its cells are shuffled), the wide view is read back."""
    from labelforge.operators import profile_table
    path = fresh_path(spark, "profile-table")
    name = "profile_" + os.path.basename(path).replace("-", "_")
    profile_table.create_profile_table(spark, name, path, buckets=8)
    try:
        stale = _segment(spark, root).select("userId", F.lit("stale").alias("acct"))
        profile_table.replace_tags(profile.to_long(stale), name)
        new = profile.to_long(_acct(spark, root, ACCT_RULES_NEW))
        profile_table.upsert_tags(new, name, ["acct"])
        return written(profile_table.wide_view(spark, name, ["acct"]), "profile-view")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def q_cell_scan_listing(spark, root):
    """The cells themselves, with their version."""
    cust = _t(spark, root, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    _, listing = cells.cell_scan(cells.melt_cells(cust, "c_custkey", "detail", version=1))
    return listing


def q_cell_scan_count(spark, root):
    """Distinct row keys of the cell view of customers."""
    cust = _t(spark, root, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    count, _ = cells.cell_scan(cells.melt_cells(cust, "c_custkey", "detail", version=1))
    return count


def q_profile_search_export(spark, root):
    """Search the wide profile and export the hits as CSV, read back."""
    cells_ = profile.union_long([profile.to_long(_segment(spark, root)), profile.to_long(_acct(spark, root))])
    hits = profile.search_cells(cells_, "segment", "eq", "builder", ["userId", "segment", "acct"])
    path = profile.export_csv(hits, fresh_path(spark, "search"))
    schema = "userId long, segment string, acct string"
    return spark.read.schema(schema).option("header", True).csv(path)


# ------------------------------------------------------------------ tag models
def q_model_match_from_catalog(spark, root):
    """M1-style run: tag 2's level-4 rule names the customer table and its fields;
    its level-5 children (nations) are the match rules."""
    from labelforge.plans import models
    inp = models.model_inputs(spark, tag_tree(spark, root), 2)
    return models.match_model(inp, "c_nationkey", "nation", key="c_custkey")


def q_models_one_scan(spark, root):
    """Four models over one customer scan and one broadcast join, one profile write."""
    from labelforge.plans.runner import CopySpec, MatchSpec, RangeSpec, tag_all
    cust = _t(spark, root, "customer", ["c_custkey", "c_mktsegment", "c_acctbal", "c_name",
                                        "c_nationkey"])
    nations = _t(spark, root, "nation", ["n_nationkey", "n_name"]) \
        .select(F.col("n_nationkey").cast("string").alias("rule"), F.col("n_name").alias("name"))
    specs = [MatchSpec("segment", "c_mktsegment", _rules(spark, SEGMENT_RULES)),
             RangeSpec("acct", "c_acctbal", _range_rules(spark, ACCT_RULES, "~", "double"),
                       "left_open"),
             CopySpec("name", "c_name"),
             MatchSpec("nation", "c_nationkey", nations)]
    long = tag_all(cust, "c_custkey", specs)
    path = fresh_path(spark, "profile")
    profile.write_profile(long, path)
    tags = ["segment", "acct", "name", "nation"]
    return profile.pivot_long(profile.read_profile(spark, path, tags), tags)


def q_aggregate_models_one_scan(spark, root):
    """Mode (payment) and recency (cycle) models over one orders scan and one shared
    two-level aggregation, one broadcast join, one profile write."""
    from labelforge.plans.runner import ModeSpec, RecencySpec, tag_aggregates
    orders = _t(spark, root, "orders", ["o_custkey", "o_orderpriority", "o_orderdate"])
    long = tag_aggregates(orders, "o_custkey",
                          ModeSpec("payment", "o_orderpriority", _rules(spark, PRIORITY_RULES)),
                          [RecencySpec("cycle", "o_orderdate",
                                       _range_rules(spark, CYCLE_RULES, "-", "int"),
                                       AS_OF_RECENCY)])
    path = fresh_path(spark, "profile")
    profile.write_profile(long, path, tags=["payment", "cycle"])
    return profile.pivot_long(profile.read_profile(spark, path), ["payment", "cycle"])


def q_stream_profile_models(spark, root):
    """The one-scan models driven by Structured Streaming: customer rows arrive as a
    file stream, each micro-batch is tagged and upserted into the profile."""
    from labelforge.plans.runner import CopySpec, MatchSpec, RangeSpec
    from labelforge.streaming.ingest import stream_profile_updates
    src = os.path.join(root, "customer.parquet")
    schema = spark.read.parquet(src).schema
    # a glob: the file source watches a folder, here the one holding the table file
    stream = spark.readStream.schema(schema).parquet(os.path.join(root, "customer.parque[t]")) \
        .select("c_custkey", "c_mktsegment", "c_acctbal", "c_name")
    specs = [MatchSpec("segment", "c_mktsegment", _rules(spark, SEGMENT_RULES)),
             RangeSpec("acct", "c_acctbal", _range_rules(spark, ACCT_RULES, "~", "double"),
                       "left_open"),
             CopySpec("name", "c_name")]
    path = fresh_path(spark, "profile")
    stream_profile_updates(stream, "c_custkey", specs, path,
                           fresh_path(spark, "ckpt")).awaitTermination()
    tags = ["segment", "acct", "name"]
    return profile.pivot_long(profile.read_profile(spark, path, tags), tags)


def q_stream_bulk_load(spark, root):
    """M18 incrementally: order TSV lines land as text files, a checkpointed
    stream parses and melts them into cells, the sink is read back."""
    from labelforge.streaming.ingest import stream_tsv_cells
    src = fresh_path(spark, "tsv-in")
    order_lines(spark, root).write.text(src)
    sink = fresh_path(spark, "cells-out")
    q = stream_tsv_cells(spark, src, sink, fresh_path(spark, "ckpt"), ["id", "st", "prio"],
                         "detail")
    q.awaitTermination()
    return spark.read.parquet(sink)


# ------------------------------------------------------------------ catalog-driven models
AS_OF_MODELS = "2001-08-02"


def model_catalog(spark: SparkSession, root: str) -> DataFrame:
    """A tag catalog whose level-4 rules point at the driver's tables."""
    def src(table, fields, extra=""):
        return (f"inType=parquet\npath={os.path.join(root, table + '.parquet')}\n"
                f"selectFieldNames={fields}{extra}")
    rows = [
        (300, -1, 4, "payment", src("orders", "o_custkey,o_orderpriority")),
        (301, 300, 5, "urgent", "1-URGENT"), (302, 300, 5, "high", "2-HIGH"),
        (303, 300, 5, "low", "5-LOW"),
        (310, -1, 4, "cycle", src("orders", "o_custkey,o_orderdate")),
        (311, 310, 5, "d0-30", "0-30"), (312, 310, 5, "d31-90", "31-90"),
        (313, 310, 5, "d91-180", "91-180"),
        (320, -1, 4, "era", src("orders", "o_orderkey,o_orderdate",
                                "\nfilterConditions=o_orderstatus[NE]P")),
        (321, 320, 5, "y95", "19950101-19951231"), (322, 320, 5, "y96-97", "19960101-19971231"),
        (323, 320, 5, "y98-01", "19980101-20011231"),
        (330, -1, 4, "acct", src("customer", "c_custkey,c_acctbal")),
        (331, 330, 5, "debt", "-1000.0~0.0"), (332, 330, 5, "mid", "0.0~5000.0"),
        (333, 330, 5, "rich", "5000.0~10000.0"),
        (340, -1, 4, "name", src("customer", "c_custkey,c_name")),
        (350, -1, 4, "status", src("orders", "o_orderkey,o_orderstatus",
                                   "\nwhereCondition=o_orderdate#year#1")),
        (351, 350, 5, "finished", "F"), (352, 350, 5, "open", "O"), (353, 350, 5, "pending", "P"),
    ]
    return literal_frame(spark, rows, "id long, pid long, level int, name string, rule string")


def _inputs(spark, root, tag_id, as_of=None):
    from labelforge.plans import models
    return models.model_inputs(spark, model_catalog(spark, root), tag_id, as_of)


def q_model_mode_from_catalog(spark, root):
    from labelforge.plans import models
    return models.mode_model(_inputs(spark, root, 300), "o_custkey", "o_orderpriority", "payment")


def q_model_recency_from_catalog(spark, root):
    from labelforge.plans import models
    return models.recency_model(_inputs(spark, root, 310), "o_custkey", "o_orderdate", "cycle",
                                AS_OF_MODELS, time_kind="timestamp")


def q_model_date_range_from_catalog(spark, root):
    from labelforge.plans import models
    return models.date_range_model(_inputs(spark, root, 320), "o_orderdate", "era",
                                   key="o_orderkey")


def q_model_ratio_from_catalog(spark, root):
    from labelforge.plans import models
    return models.ratio_range_model(_inputs(spark, root, 330), "c_acctbal", "acct",
                                    key="c_custkey")


def q_model_copy_from_catalog(spark, root):
    from labelforge.plans import models
    return models.copy_model(_inputs(spark, root, 340), "c_name", "name", key="c_custkey")


def q_model_window_match_from_catalog(spark, root):
    from labelforge.plans import models
    return models.match_model(_inputs(spark, root, 350, AS_OF_WINDOW), "o_orderstatus", "status",
                              key="o_orderkey")


def q_model_distribution(spark, root):
    from labelforge.plans import models
    return models.distribution(q_model_mode_from_catalog(spark, root), "payment")


def q_model_save_profile(spark, root):
    """Two model runs saved into one long profile (upsert), read back as a wide view."""
    from labelforge.plans import models
    path = fresh_path(spark, "profile")
    models.save(q_model_mode_from_catalog(spark, root), path)
    models.save(q_model_recency_from_catalog(spark, root), path)
    return profile.pivot_long(profile.read_profile(spark, path), ["payment", "cycle"])


# ------------------------------------------------------------------ rating jobs
_RATIO_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _rated_embeddings(spark, root):
    """Classifier input: the label (0-9) read as a rating letter, scored with H11."""
    from labelforge.plans import rating
    emb = _t(spark, root, "embeddings", ["vec_id", "embedding", "label"])
    letters = F.array(*[F.lit(x) for x in scores.RATING_LETTERS])
    df = emb.select("vec_id", learning.array_features("embedding").alias("vec"),
                    F.try_element_at(letters, (F.col("label") + 1).cast("int")).alias("rating"))
    return rating.scored(df, "rating", scores.SCALE_REGRESSION)


def q_rating_logistic_eval(spark, root):
    """Rows and scores per split, and whether the fit's gradient vanishes."""
    from labelforge.plans import rating
    data = _rated_embeddings(spark, root).withColumn("split", learning.split_label("vec_id", 80))
    train = data.where("split = 'train'")
    model = rating.fit(rating.logistic_pipeline(None, "vec", max_iter=100), train)
    small = _gradient_small(model.stages[-1], model.stages[0].transform(train), "features", "score")
    return rating.evaluate(model, data).join(F.broadcast(small), F.col("split") == F.col("_split"), "left").select(
        "split", "n", "gradient_small", (F.col("within_one") >= F.col("accuracy")).alias("within_one_more"))


def q_rating_predict_profile(spark, root):
    """Predicted letters of all rows written to the profile and read back."""
    from labelforge.plans import models, rating
    data = _rated_embeddings(spark, root)
    train, _ = learning.hash_split(data, "vec_id", 80)
    model = rating.fit(rating.logistic_pipeline(None, "vec", max_iter=20), train)
    path = fresh_path(spark, "profile")
    models.save(rating.predicted_tag(model, data, "vec_id"), path)
    wide = profile.pivot_long(profile.read_profile(spark, path), ["predictedCredit"])
    known = F.col("predictedCredit").isin([x for _, x in scores.SCORE_LETTERS] + [""])
    return wide.agg(F.count(F.lit(1)).alias("n"), F.bool_and(known).alias("letters_known"))


def q_rating_tree_eval(spark, root):
    """A tree of depth 5 on rated lineitems; per split its rows, and whether every one of the
    tree's splits is a best one among all thresholds of all features."""
    from labelforge.plans import rating
    li = _t(spark, root, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice"])
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    grade = F.pmod(F.floor(unit / 100) + F.floor(F.col("l_quantity") / 13) + F.floor(F.col("l_discount") * 40), F.lit(4))
    data = li.withColumn("score_text", F.element_at(F.array(*map(F.lit, "ABCD")), (grade + 1).cast("int"))) \
        .withColumn("unit", F.least(F.floor(unit / 100), F.lit(25)).cast("double")) \
        .withColumn("split", learning.split_label("l_orderkey", 70))
    train = data.where("split = 'train'")
    fitted = rating.fit(learning.tree_pipeline("score_text", columns=["l_quantity", "l_discount", "l_tax", "unit"],
                                               max_categories=2, max_depth=5, max_bins=64), train)
    rows = train
    for stage in fitted.stages[:-1]:
        rows = stage.transform(rows)
    checked = learning.split_check(fitted.stages[-1], rows, "indexedFeatures", "indexedLabel")
    best = checked.agg(F.lit("train").alias("_split"), F.bool_and(
        F.col("chosen") >= F.col("best") * (1 - 1e-9)).alias("splits_best"), F.max("n").alias("root_rows"))
    out = learning.with_label_restore(fitted).transform(data).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("predictedLabel").isin(*"ABCD")).alias("known"))
    return out.join(F.broadcast(best), F.col("split") == F.col("_split"), "left").drop("_split")


def q_normalised_classify(spark, root):
    """M15 as one job: a delimited table read, labels indexed, features assembled and L2
    normalised, a logistic model fitted, judged, saved, loaded, and asked for one literal
    vector."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import Normalizer, StringIndexer, VectorAssembler
    emb = _t(spark, root, "embeddings", ["vec_id", "embedding", "label"])
    size = F.size("embedding")
    width = emb.agg(F.max(size).alias("n")).first()["n"] or 0
    names = [f"x{k}" for k in range(width)]
    path = profile.export_csv(emb.where(size == width).select(
        "vec_id", F.concat(F.lit("class-"), F.col("label").cast("string")).alias("kind"),
        *[F.col("embedding")[k].cast("double").alias(x) for k, x in enumerate(names)]),
        fresh_path(spark, "vectors"))
    rows = read_csv(spark, path, "vec_id long, kind string, " + ", ".join(f"{x} double" for x in names), header=True) \
        .withColumn("split", learning.split_label("vec_id", 80))
    stages = [StringIndexer(inputCol="kind", outputCol="label"),
              VectorAssembler(inputCols=names, outputCol="raw"),
              Normalizer(inputCol="raw", outputCol="features", p=2.0),
              LogisticRegression(maxIter=100, family="multinomial")]
    fitted = Pipeline(stages=stages).fit(rows.where("split = 'train'"))
    model = PipelineModel.load(learning.save_model(fitted, fresh_path(spark, "model")))
    one = spark.createDataFrame([(-1, "class-0", *[1.0] + [0.0] * (width - 1), "literal")],
                                rows.schema)
    labels = len(fitted.stages[0].labels)
    out = model.transform(rows.unionByName(one))
    unit = F.aggregate(learning.vector_elements("features"), F.lit(0.0), lambda a, x: a + x * x)
    found = out.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("prediction") < labels).alias("known_class"),
        F.bool_and(F.abs(unit - 1) < 1e-6).alias("unit_length"))
    train = out.where("split = 'train'").select("features", "label")
    small = _gradient_small(model.stages[-1], train)
    return found.join(F.broadcast(small), F.col("split") == F.col("_split"), "left").drop("_split")


def q_ratio_correlation(spark, root):
    from labelforge.plans import rating
    li = _t(spark, root, "lineitem", _RATIO_COLUMNS)
    letters = F.array(*[F.lit(x) for x in scores.RATING_LETTERS])
    li = li.withColumn("rating", F.try_element_at(
        letters, (F.pmod(F.col("l_quantity").cast("long"), F.lit(11)) + 1).cast("int")))
    return rating.ratio_correlation(li, _RATIO_COLUMNS, "rating")


QUERIES = {
    "tag_rules_for": q_tag_rules_for,
    "tag_children": q_tag_children,
    "tag_model_left_join": q_tag_model_left_join,
    "tag_insert_if_absent": q_tag_insert_if_absent,
    "rule_kv_parse": q_rule_kv_parse,
    "wide_read_conditions": q_wide_read_conditions,
    "wide_read_union_schema": q_wide_read_union_schema,
    "wide_read_relative_window": q_wide_read_relative_window,
    "rule_match_inner": q_rule_match_inner,
    "rule_match_lookup": q_rule_match_lookup,
    "copy_tag": q_copy_tag,
    "range_tag_inclusive": q_range_tag_inclusive,
    "range_tag_half_open": q_range_tag_half_open,
    "recency_tag": q_recency_tag,
    "mode_category": q_mode_category,
    "mode_category_tag": q_mode_category_tag,
    "top1_per_group": q_top1_per_group,
    "top1_per_group_sql": q_top1_per_group_sql,
    "tag_distribution": q_tag_distribution,
    "filtered_count": q_filtered_count,
    "row_get": q_row_get,
    "profile_merge_wide": q_profile_merge_wide,
    "profile_upsert": q_profile_upsert,
    "profile_long_pivot": q_profile_long_pivot,
    "profile_search": q_profile_search,
    "tsv_ingest_strict": q_tsv_ingest_strict,
    "tsv_ingest_trim_trailing": q_tsv_ingest_trim_trailing,
    "cells_melt": q_cells_melt,
    "cells_sorted_rank": q_cells_sorted_rank,
    "kv_tags_explode": q_kv_tags_explode,
    "conditional_replace": q_conditional_replace,
    "code_name_map": q_code_name_map,
    "date_shift_epoch": q_date_shift_epoch,
    "date_window_bounds": q_date_window_bounds,
    "letter_to_score": q_letter_to_score,
    "score_to_letter": q_score_to_letter,
    "cast_features_double": q_cast_features_double,
    "corr_matrix": q_corr_matrix,
    "string_index": q_string_index,
    "index_to_string": q_index_to_string,
    "assemble_max_abs": q_assemble_max_abs,
    "l2_normalize": q_l2_normalize,
    "vector_index_kinds": q_vector_index_kinds,
    "split_deterministic": q_split_deterministic,
    "accuracy": q_accuracy,
    "tolerance_accuracy": q_tolerance_accuracy,
    "logistic_predict_tag": q_logistic_predict_tag,
    "decision_tree_predict": q_decision_tree_predict,
    "model_save_load": q_model_save_load,
    "csv_export_import": q_csv_export_import,
    "table_append": q_table_append,
    # beyond the first fifty
    "tag_level_lookup": q_tag_level_lookup,
    "tag_path_insert": q_tag_path_insert,
    "range_rule_parse": q_range_rule_parse,
    "recency_tag_epoch": q_recency_tag_epoch,
    "top3_per_group": q_top3_per_group,
    "cells_pivot_back": q_cells_pivot_back,
    "bulk_load_cells": q_bulk_load_cells,
    "sorted_order_check": q_sorted_order_check,
    "point_get": q_point_get,
    "order_cleanup": q_order_cleanup,
    "date_text_to_int": q_date_text_to_int,
    "rating_letter_score": q_rating_letter_score,
    "numeric_summary": q_numeric_summary,
    "profile_search_export": q_profile_search_export,
    "model_match_from_catalog": q_model_match_from_catalog,
    "models_one_scan": q_models_one_scan,
    "stream_bulk_load": q_stream_bulk_load,
    "aggregate_models_one_scan": q_aggregate_models_one_scan,
    "stream_profile_models": q_stream_profile_models,
    "catalog_table_append": q_catalog_table_append,
    "cell_scan_count": q_cell_scan_count,
    "profile_table_upsert": q_profile_table_upsert,
    "model_mode_from_catalog": q_model_mode_from_catalog,
    "model_recency_from_catalog": q_model_recency_from_catalog,
    "model_date_range_from_catalog": q_model_date_range_from_catalog,
    "model_ratio_from_catalog": q_model_ratio_from_catalog,
    "model_copy_from_catalog": q_model_copy_from_catalog,
    "model_window_match_from_catalog": q_model_window_match_from_catalog,
    "model_distribution": q_model_distribution,
    "model_save_profile": q_model_save_profile,
    "rating_logistic_eval": q_rating_logistic_eval,
    "rating_predict_profile": q_rating_predict_profile,
    "rating_tree_eval": q_rating_tree_eval,
    "ratio_correlation": q_ratio_correlation,
    "rule_text_edges": q_rule_text_edges,
    "top1_nulls": q_top1_nulls,
    "corr_matrix_wide": q_corr_matrix_wide,
    "profile_empty_run": q_profile_empty_run,
    "profile_latest_wins": q_profile_latest_wins,
    "kv_tags_key_cell": q_kv_tags_key_cell,
    "cell_scan_listing": q_cell_scan_listing,
    "tsv_ingest_wide": q_tsv_ingest_wide,
    "positional_features": q_positional_features,
    "tolerance_flag": q_tolerance_flag,
    "normalised_classify": q_normalised_classify,
}
