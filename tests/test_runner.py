
from labelforge.plans.runner import (CopySpec, MatchSpec, ModeSpec, RangeSpec, RecencySpec,
                                     tag_aggregates, tag_all)
from tests.conftest import rows


def _specs(spark):
    rules = spark.createDataFrame([("1", "student"), ("2", "teacher")], "rule string, name string")
    ranges = spark.createDataFrame([("young", 0.0, 29.0), ("old", 29.0, 200.0)],
                                   "name string, start double, end double")
    return [MatchSpec("job", "job", rules), RangeSpec("age", "age", ranges, "left_open"),
            CopySpec("name", "name")]


def test_tag_all_broadcast_and_salted_paths_agree(spark):
    df = spark.createDataFrame([(1, "1", 20.0, "ann"), (2, "2", 29.0, "bob"), (3, "9", 30.0, None),
                                (4, None, None, "dee")], "id int, job string, age double, name string")
    one = rows(tag_all(df, "id", _specs(spark)))
    assert one == [(1, "age", "young"), (1, "job", "student"), (1, "name", "ann"),
                   (2, "age", "young"), (2, "job", "teacher"), (2, "name", "bob"),
                   (3, "age", "old"), (4, "name", "dee")]
    salted = tag_all(df, "id", _specs(spark), max_broadcast_bytes=0)
    assert rows(salted) == one
    salted_plan = salted._jdf.queryExecution().optimizedPlan().toString()
    # salted join; the business frame is read once (plus the two rule frames and the blocks)
    assert "_rsalt" in salted_plan and salted_plan.count("LogicalRDD") == 1 + 3
    plan = tag_all(df, "id", _specs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_tag_aggregates_with_epoch_text_and_no_mode(spark):
    df = spark.createDataFrame([("u", "7", "a"), ("u", "1000000000", "b"), ("v", "86400", "b"),
                                ("v", "90000", None)], "uid string, t string, c string")
    r = spark.createDataFrame([("recent", 0, 7), ("old", 8, 100000)], "name string, start int, end int")
    rec = RecencySpec("cycle", "t", r, "2001-09-12", time_kind="epoch")
    assert rows(tag_aggregates(df, "uid", recency=[rec])) == [("u", "cycle", "recent"),
                                                             ("v", "cycle", "old")]
    rules = spark.createDataFrame([("a", "A"), ("b", "B")], "rule string, name string")
    both = rows(tag_aggregates(df, "uid", ModeSpec("mode", "c", rules), [rec]))
    # u: a and b once each -> tie -> smallest 'a'; v: only b counted (null ignored)
    assert both == [("u", "cycle", "recent"), ("u", "mode", "A"), ("v", "cycle", "old"),
                    ("v", "mode", "B")]


def test_execute_dispatches_aggregate_models(spark):
    import pytest
    from labelforge.plans import catalogue, models
    root = "/root/testdata/sf0.001"
    cat = catalogue.model_catalog(spark, root)
    mode = models.execute(spark, cat, 300, "mode", key="o_custkey", category="o_orderpriority",
                          tag="payment")
    assert set(mode.columns) == {"userId", "payment"} and mode.count() > 0
    rec = models.execute(spark, cat, 310, "recency", as_of="2001-08-02", key="o_custkey",
                         time_field="o_orderdate", tag="cycle", time_kind="timestamp")
    seen = {r[0] for r in rec.select("cycle").distinct().collect()}
    assert seen and seen <= {"d0-30", "d31-90", "d91-180"}
    with pytest.raises(ValueError, match="kind must be one of"):
        models.execute(spark, cat, 300, "bogus")
