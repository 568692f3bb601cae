import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelforge.functions.casts import positional_columns
from labelforge.functions.dates import parse_date
from labelforge.session import fresh_path
from labelforge.sources import catalog
from labelforge.sources.delimited import read_csv
from labelforge.sources.tables import append_parquet, read_catalog_table
from labelforge.sources.wide import business_data
from tests.conftest import rows


@pytest.fixture
def members(spark):
    return spark.createDataFrame([("1", "m", "2019-08-30"), ("2", "f", "2019-06-01"),
                                  ("3", None, "2019-08-31")], "id string, gender string, modified string")


def test_business_data_dispatch_by_in_type(spark, members):
    pq = fresh_path(spark, "m-parquet")
    members.write.parquet(pq)
    csv = fresh_path(spark, "m-csv")
    members.write.option("header", True).csv(csv)
    tsv = fresh_path(spark, "m-tsv")
    members.write.option("header", True).option("sep", "\t").csv(tsv)
    members.write.saveAsTable("members_tbl")
    want = [("1", "m"), ("3", None)]
    for meta in ({"inType": "PARQUET", "path": pq}, {"inType": "csv", "path": csv},
                 {"inType": "tsv", "path": tsv}, {"inType": "table", "table": "members_tbl"}):
        meta = dict(meta, selectFieldNames="id,gender", whereCondition="modified#day#30")
        got = rows(business_data(spark, meta, as_of="2019-09-01"))
        assert got == want, meta["inType"]
    with pytest.raises(ValueError, match="unsupported inType"):
        business_data(spark, {"inType": "hbase", "selectFieldNames": "id"})
    with pytest.raises(ValueError, match="lacks 'path'"):
        business_data(spark, {"inType": "parquet", "selectFieldNames": "id"})
    with pytest.raises(ValueError, match="lacks 'selectFieldNames'"):
        business_data(spark, {"inType": "parquet", "path": pq})
    with pytest.raises(ValueError, match="needs as_of"):
        business_data(spark, {"inType": "parquet", "path": pq, "selectFieldNames": "id",
                              "whereCondition": "modified#day#1"})


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_files_with_different_columns_give_every_cell(spark, kind):
    from labelforge.sources.wide import folder_parts
    path = fresh_path(spark, "evolving")
    meta = {"inType": kind, "path": path, "selectFieldNames": "id,x,y"}
    spark.createDataFrame([(1, 7)], "id long, x int").write.format(kind).save(path)
    spark.createDataFrame([(2, "b")], "id long, y string").write.mode("append").format(kind).save(path)
    want = [("1", "7", None), ("2", None, "b")]
    assert rows(business_data(spark, meta)) == want
    assert len(folder_parts(spark, kind, path)) == 1
    assert rows(business_data(spark, dict(meta, filterConditions="y[EQ]b"))) == want[1:]
    # a type that cannot be merged, in a partitioned folder
    spark.createDataFrame([(3, "t")], "id long, x string").write.mode("append").format(kind).save(path)
    assert rows(business_data(spark, meta)) == want + [("3", "t", None)]


def test_csv_files_with_another_header_are_an_error(spark, members):
    path = fresh_path(spark, "headers")
    members.write.option("header", True).csv(path)
    members.select("gender", "id", "modified").write.mode("append").option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        business_data(spark, {"inType": "csv", "path": path, "selectFieldNames": "id"}).collect()


def test_catalog_table_read_and_append(spark, members):
    members.write.mode("overwrite").saveAsTable("members_append")
    members.write.mode("append").saveAsTable("members_append")
    assert read_catalog_table(spark, "members_append", ["id"]).count() == 6
    path = fresh_path(spark, "append")
    append_parquet(members, path)
    append_parquet(members, path)
    assert spark.read.parquet(path).count() == 6


def test_csv_with_declared_schema(spark):
    path = fresh_path(spark, "iris-like")
    spark.createDataFrame([("1,5.1,setosa",), ("2,x,versicolor",)], "value string").write.text(path)
    schema = T.StructType([T.StructField("id", T.DoubleType()), T.StructField("f", T.DoubleType()),
                           T.StructField("category", T.StringType())])
    got = rows(read_csv(spark, path, schema))
    assert got == [(1.0, 5.1, "setosa"), (2.0, None, "versicolor")]


def test_tag_tree_helpers(spark):
    tags = spark.createDataFrame(
        [(1, -1, 1, "root", None), (10, 1, 4, "gender", "inType=parquet"), (11, 10, 5, "m", "1"),
         (12, 10, 5, "f", "2"), (13, 10, 5, "f", "2")], "id long, pid long, level int, name string, rule string")
    r = catalog.load_tag_rules(tags, 10)
    assert [x["id"] for x in r.collect()] == [10, 11, 12, 13]
    assert catalog.model_rule_text(r) == "inType=parquet"
    assert rows(catalog.list_tags(tags, level=5, pid=10), "id") == [(11,), (12,), (13,)]
    assert rows(catalog.list_tags(tags), "id") == rows(tags, "id")
    with pytest.raises(ValueError, match="no level-4"):
        catalog.model_rule_text(catalog.load_tag_rules(tags, 11))
    models = spark.createDataFrame([(10, "GenderModel", 3)], "tag_id long, model_name string, state int")
    joined = rows(catalog.tags_with_models(tags, models).where(F.col("level") >= 4),
                  "id", "model_name")
    assert joined == [(10, "GenderModel"), (11, None), (12, None), (13, None)]
    paths = spark.createDataFrame([("root", "gender", "x"), ("root", "age", None)],
                                  "l1 string, l2 string, l3 string")
    out = catalog.insert_tag_paths(tags, paths, max_level=3)
    new = rows(out.where(F.col("id") > 13), "id", "pid", "level", "name")
    assert new == [(14, 1, 2, "age"), (15, 1, 2, "gender"), (16, 15, 3, "x")]


def test_paths_of_any_depth_are_inserted_in_one_pass(spark):
    schema = "id long, pid long, level int, name string, rule string"
    tags = spark.createDataFrame([(5, -1, 1, "a", None), (9, -1, 1, "a", None), (7, 5, 2, "b", None),
                                  (8, 9, 2, "c", None), (6, 5, 3, "far", None)], schema)
    paths = [("a", "b", "c", "d", "e", "f"), ("a", "b", "x", None, "ignored", None), ("z", None, None, None, None, None),
             ("a", "c", None, None, None, None), (None, "b", None, None, None, None), ("z", "b", None, None, None, None)]
    frame = spark.createDataFrame(paths, ", ".join(f"l{k} string" for k in range(1, 7)))
    out = {r["id"]: (r["pid"], r["level"], r["name"]) for r in catalog.insert_tag_paths(tags, frame).collect()}
    assert {k: v for k, v in out.items() if k <= 9} == {5: (-1, 1, "a"), 9: (-1, 1, "a"), 7: (5, 2, "b"),
                                                        8: (9, 2, "c"), 6: (5, 3, "far")}
    # ids follow (level, path); a row below the second "a" is a path of the catalog as well
    assert {k: v for k, v in out.items() if k > 9} == {
        10: (-1, 1, "z"), 11: (10, 2, "b"), 12: (7, 3, "c"), 13: (7, 3, "x"), 14: (12, 4, "d"), 15: (14, 5, "e"),
        16: (15, 6, "f")}
    again = catalog.insert_tag_paths(catalog.insert_tag_paths(tags, frame), frame)
    assert again.count() == len(out)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_small_helpers(spark):
    assert positional_columns(["id", "a", "b", "label"], 1, -1) == ["a", "b"]
    df = spark.createDataFrame([("2019-02-30",), ("2019-02-28",)], "t string")
    assert [r[0] for r in df.select(parse_date("t")).collect()][1].isoformat() == "2019-02-28"
