import pytest
from pyspark.sql import functions as F

from labelforge.functions.rules import parse_kv_rule, parse_range
from labelforge.operators.match import rule_match
from labelforge.sources.catalog import insert_if_absent
from labelforge.sources.conditions import parse_conditions, relative_window
from labelforge.sources.wide import business_data, read_wide, rule_map
from tests.conftest import rows


def test_kv_rule_parse_trims_keeps_later_equals_and_last_wins(spark):
    df = spark.createDataFrame([(1, "inType=hbase\n a = b=c \n\nx=1\nx=2")], "id int, rule string")
    m = df.select(parse_kv_rule("rule").alias("m")).first()["m"]
    assert m == {"inType": "hbase", "a": "b=c", "x": "2"}


def test_kv_rule_line_without_separator_raises(spark):
    df = spark.createDataFrame([(1, "a=1\nbroken")], "id int, rule string")
    with pytest.raises(Exception, match="rule line without"):
        df.select(parse_kv_rule("rule")).collect()
    lenient = df.select(parse_kv_rule("rule", strict=False).alias("m")).first()["m"]
    assert lenient == {"a": "1"}


def test_driver_rule_map_matches():
    assert rule_map("inType=parquet\npath = /x=y\n\nk=1\nk=2") == \
        {"inType": "parquet", "path": "/x=y", "k": "2"}
    with pytest.raises(ValueError):
        rule_map("novalue")


def test_parse_range_int_double_and_malformed(spark):
    df = spark.createDataFrame([("19500101-19591231",), ("0-7",), ("-10-5",), ("-10--5",), (" 1 -\t2\r",), (None,),
                                ("bad",), ("1-2-3",), ("-",), ("5-",)], "t string")
    out = df.select(parse_range("t", "-", "int", on_bad_rule="drop").alias("r")).select("r.start", "r.end").collect()
    assert [tuple(r) for r in out] == [(19500101, 19591231), (0, 7), (-10, 5), (-10, -5), (1, 2)] + [(None, None)] * 5
    with pytest.raises(Exception, match="malformed range rule"):
        df.select(parse_range("t", "-", "int").alias("r")).collect()
    d = spark.createDataFrame([("-1.5~0.25",)], "t string") \
        .select(parse_range("t", "~", "double").alias("r")).first()["r"]
    assert (d["start"], d["end"]) == (-1.5, 0.25)


RULE_TEXTS = ["inType=x\r\n\tfam =\tdetail\r", "a=1\n\n\r\nb = c=d \n", " k\t=\x0b v\x0c\nk=w"]


def test_both_rule_parsers_agree(spark):
    df = spark.createDataFrame([(t,) for t in RULE_TEXTS], "t string")
    got = [r[0] for r in df.select(parse_kv_rule("t")).collect()]
    assert got == [rule_map(t) for t in RULE_TEXTS]
    assert got[0] == {"inType": "x", "fam": "detail"}


def test_rule_match_compares_text_and_keeps_ansi_quiet(spark):
    df = spark.createDataFrame([(1, 1), (2, 7)], "id int, v int")
    rules = spark.createDataFrame([("1", "one"), ("01", "padded"), ("x", "ex")], "rule string, name string")
    assert rows(rule_match(df, "v", rules)) == [(1, "one")]


def test_insert_if_absent_takes_one_of_equal_new_rows(spark):
    old = spark.createDataFrame([("a", 1, None)], "name string, level int, pid long")
    new = spark.createDataFrame([("a", 1, None), ("b", 1, 3), ("b", 1, 3)], "name string, level int, pid long")
    assert rows(insert_if_absent(old, new)) == [("a", 1, None), ("b", 1, 3)]


def test_relational_rule_needs_its_bounds(spark):
    meta = {"inType": "jdbc", "url": "jdbc:x", "table": "t", "selectFieldNames": "a"}
    with pytest.raises(ValueError, match="partitionColumn"):
        business_data(spark, meta)


def test_condition_parsing():
    conds = parse_conditions("modified[GE]20190601,modified[le]20191201,x[Ne]a b")
    assert [(c.field, c.op, c.value) for c in conds] == [
        ("modified", "ge", "20190601"), ("modified", "le", "20191201"), ("x", "ne", "a b")]
    with pytest.raises(ValueError, match="unknown operator"):
        parse_conditions("a[LIKE]x")
    with pytest.raises(ValueError, match="malformed"):
        parse_conditions("no brackets")


def test_relative_window_units():
    assert relative_window("modified#day#30", "2019-09-01") == \
        "modified[GE]2019-08-01,modified[LE]2019-08-31"
    assert relative_window("modified#month#6", "2019-09-01") == \
        "modified[GE]2019-03-04,modified[LE]2019-08-31"
    assert relative_window("modified#year#1", "2019-09-01") == \
        "modified[GE]2018-08-31,modified[LE]2019-08-31"


def test_typed_date_conditions_equal_text_comparison(spark):
    """The pushed-down typed predicate must keep exactly the rows the text comparison keeps."""
    import datetime as dt
    ts = [dt.datetime(2019, 8, 31, 0, 0), dt.datetime(2019, 8, 31, 23, 59, 59),
          dt.datetime(2019, 9, 1, 0, 0), dt.datetime(2019, 8, 30, 12, 0), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id int, m timestamp_ntz")
    text = F.date_format("m", "yyyy-MM-dd")
    for op, sym in [("ge", ">="), ("gt", ">"), ("lt", "<"), ("le", "<="), ("eq", "="),
                    ("ne", "!=")]:
        got = rows(read_wide(df, ["id"], f"m[{op}]2019-08-31"))
        want = rows(df.where(F.expr(f"date_format(m, 'yyyy-MM-dd') {sym} '2019-08-31'"))
                    .select(F.col("id").cast("string")))
        assert got == want, op
    # non-canonical value: falls back to text comparison ("2019-08-31 ..." > "2019-08-3")
    got = rows(read_wide(df, ["id"], "m[gt]2019-08-3"))
    want = rows(df.where(text > "2019-08-3").select(F.col("id").cast("string")))
    assert got == want


def test_missing_cells_keep_or_drop(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    assert rows(read_wide(df, ["id"], "v[EQ]a")) == [("1",)]
    assert rows(read_wide(df, ["id"], "v[EQ]a", missing="keep")) == [("1",), ("2",)]
    # a field the table lacks is a null cell
    assert rows(read_wide(df, ["id", "zz"])) == [("1", None), ("2", None)]


def test_pushdown_reaches_parquet_scan(spark):
    root = "/root/testdata/sf0.001"
    src = spark.read.parquet(f"{root}/orders.parquet")
    df = read_wide(src, ["o_orderkey"], "o_orderdate[GE]1997-01-01,o_orderstatus[NE]F")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters: "):]
    assert "GreaterThanOrEqual(o_orderdate" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate" in plan


def test_integer_equality_rewrite_only_for_canonical_text(spark):
    df = spark.createDataFrame([(0,), (7,), (-7,)], "k int")
    for value in ["0", "-0", "7", "07", "-7", " 7", "+7"]:
        got = rows(read_wide(df, ["k"], f"k[eq]{value}"))
        want = rows(df.where(F.col("k").cast("string") == value).select(F.col("k").cast("string")))
        assert got == want, value
