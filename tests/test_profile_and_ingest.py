import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from labelforge.operators import profile
from labelforge.operators.ordering import global_rank
from labelforge.session import fresh_path
from labelforge.sources import cells
from labelforge.sources.delimited import parse_cells, parse_delimited_lines, read_tsv
from tests.conftest import rows


def test_upsert_keeps_untouched_columns_and_keys(spark):
    old = spark.createDataFrame([("1", "m", "a"), ("2", "f", "b"), ("3", "m", None)],
                                "userId string, gender string, job string")
    new = spark.createDataFrame([("2", "x"), ("4", "y"), ("3", None)], "userId string, job string")
    out = rows(profile.upsert_wide(old, new), "userId", "gender", "job")
    assert out == [("1", "m", "a"), ("2", "f", "x"), ("3", "m", None), ("4", None, "y")]


def test_merge_wide_is_one_shuffle_pivot(spark):
    a = spark.createDataFrame([("1", "m"), ("2", "f")], "userId string, gender string")
    b = spark.createDataFrame([("2", "30s"), ("3", "20s")], "userId string, age string")
    out = profile.merge_wide([a, b])
    assert rows(out, "userId", "gender", "age") == [("1", "m", None), ("2", "f", "30s"),
                                                    ("3", None, "20s")]
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_write_profile_replace_tag_and_upsert(spark):
    path = fresh_path(spark, "test-profile")
    first = spark.createDataFrame([("1", "gender", "m"), ("2", "gender", "f"),
                                   ("1", "job", "a")], "userId string, tag string, value string")
    profile.write_profile(first, path)
    # replace_tag: only the gender partition is replaced; key 2 loses its gender
    profile.write_profile(spark.createDataFrame([("1", "gender", "x")],
                                                "userId string, tag string, value string"), path)
    assert rows(profile.read_profile(spark, path), "userId", "tag", "value") == \
        [("1", "gender", "x"), ("1", "job", "a")]
    # upsert: key 1 keeps job, key 3 is added
    profile.write_profile(spark.createDataFrame([("3", "job", "b")],
                                                "userId string, tag string, value string"),
                          path, mode="upsert")
    assert rows(profile.read_profile(spark, path, ["job"]), "userId", "tag", "value") == \
        [("1", "job", "a"), ("3", "job", "b")]


CELL = "userId string, tag string, value string, version long"


def test_latest_value_wins_on_every_write(spark):
    batch = spark.createDataFrame([("1", "job", "z", 1), ("1", "job", "a", 2)], CELL)
    for mode in ("replace_tag", "upsert"):
        path = fresh_path(spark, "test-profile")
        for _ in range(2):  # the first write and a later one
            profile.write_profile(batch, path, mode=mode)
            assert rows(profile.read_profile(spark, path), "userId", "tag", "value") == [("1", "job", "a")]
    profile.write_profile(spark.createDataFrame([("1", "job", "b", 0)], CELL), path, mode="upsert")
    assert rows(profile.read_profile(spark, path), "value") == [("b",)]  # a later run, whatever its versions


def test_empty_run_clears_its_tag_only_and_leaves_no_stage(spark):
    root = fresh_path(spark, "test-root")
    path = root + "/store"
    profile.write_profile(spark.createDataFrame([("1", "job", "a", 0), ("1", "age", "b", 0)], CELL), path)
    conf = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    profile.write_profile(spark.createDataFrame([], CELL), path, tags=["job"])
    assert rows(profile.read_profile(spark, path), "userId", "tag", "value") == [("1", "age", "b")]
    profile.compact_profile(spark, path)
    assert rows(profile.read_profile(spark, path), "userId", "tag", "value") == [("1", "age", "b")]
    assert sorted(os.listdir(root.removeprefix("file:"))) == ["store"]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == conf


def test_replayed_run_changes_nothing(spark):
    path = fresh_path(spark, "test-profile")
    cells_ = spark.createDataFrame([("1", "job", "a", 0), ("2", "job", "b", 0)], CELL)
    for _ in range(2):
        profile.write_profile(cells_, path, mode="upsert", run=5)
    assert rows(profile.read_profile(spark, path), "userId", "value") == [("1", "a"), ("2", "b")]


def test_runs_at_the_same_time_keep_their_order_and_both_survive(spark):
    from labelforge.operators.run_log import RunLog
    path = fresh_path(spark, "test-profile")
    first, second = (spark.createDataFrame(x, CELL) for x in (
        [("1", "job", "zzz", 0), ("3", "job", "c", 0)], [("1", "job", "aaa", 0), ("2", "job", "old", 0)]))
    log = RunLog(spark, path)
    a = log.claim("first")  # claims its place, then takes its time
    profile.write_profile(second, path, mode="upsert", run="second")
    assert rows(profile.read_profile(spark, path), "userId", "value") == [("1", "aaa"), ("2", "old")]
    with pytest.raises(RuntimeError, match="not complete"):
        profile.compact_profile(spark, path)
    assert profile.write_profile(first, path, mode="upsert", run="first") == a
    # all cells are there, and the later claim counts whatever its text
    assert rows(profile.read_profile(spark, path), "userId", "value") == [("1", "aaa"), ("2", "old"), ("3", "c")]
    # a replacing run of the earlier place would not touch the later one's cells
    profile.write_profile(first, path, run="first")
    assert rows(profile.read_profile(spark, path), "userId", "value") == [("1", "aaa"), ("2", "old"), ("3", "c")]
    # two claims that list the same runs
    names = {RunLog(spark, path).claim() for _ in range(2)} | {f"{9:012d}-a", f"{9:012d}-b"}
    assert len(names) == 4


def test_a_reader_sees_all_of_a_run_or_nothing(spark):
    from labelforge.operators.run_log import RUN, RunLog
    path = fresh_path(spark, "test-profile")
    profile.write_profile(spark.createDataFrame([("1", "job", "a", 0)], CELL), path)
    log = RunLog(spark, path)
    run = log.claim()  # dies before its commit
    profile._append_run(profile.latest_cells(spark.createDataFrame([("1", "job", "b", 0), ("2", "age", "c", 0)], CELL)),
                        path, run, "userId", log)
    assert rows(profile.read_profile(spark, path), "userId", "tag", "value") == [("1", "job", "a")]
    log.commit(run, ["age"])
    assert rows(profile.read_profile(spark, path), "userId", "tag", "value") == [("1", "job", "b"), ("2", "age", "c")]
    assert RUN == "run"


def files_read(df):
    """Files that the scan of a plan without shuffles opened."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return plan.collectLeaves().head().metrics().apply("numFiles").value()


def test_compaction_reads_and_leaves_what_counts(spark):
    path = fresh_path(spark, "test-profile")
    for k in range(4):
        profile.write_profile(spark.createDataFrame([(str(k), "job", f"v{k}", 0), ("x", "age", str(k), 0)], CELL),
                              path, mode="upsert")
    want = [(str(k), "job", f"v{k}") for k in range(4)] + [("x", "age", "3")]
    run = profile.compact_profile(spark, path, ["job"])
    read = profile.read_profile(spark, path)
    assert rows(read, "userId", "tag", "value") == sorted(want, key=repr)
    assert files_read(profile._stored(spark, path, ["job"])) == 1  # earlier folders are pruned
    assert run in {r for r, in profile._stored(spark, path, ["job"]).select("run").distinct().collect()}
    profile.write_profile(spark.createDataFrame([("0", "job", "new", 0)], CELL), path, mode="upsert")
    deleted = profile.vacuum_profile(spark, path)
    assert len(deleted) == 4 and all(x.startswith("tag=job/") for x in deleted)
    want = [("0", "job", "new")] + want[1:]
    assert rows(profile.read_profile(spark, path), "userId", "tag", "value") == sorted(want, key=repr)
    profile.compact_profile(spark, path)
    profile.vacuum_profile(spark, path)
    assert rows(profile.read_profile(spark, path), "userId", "tag", "value") == sorted(want, key=repr)


@pytest.mark.parametrize("mode", ["strict", "trim_trailing"])
def test_cells_by_place_equal_melted_columns(spark, mode):
    names = ["b", "id"] + [f"f{k:02d}" for k in range(120)]
    lines = ["\t".join([f"b{k}", str(k)] + [str(k * j % 7) if j % 5 else "" for j in range(120 + (k == 3))])
             for k in range(6)] + [None, "", "\t" * 121]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    for key in (False, True):
        got = parse_cells(frame, names, "id", "d", mode=mode, include_key=key, version=4)
        want = cells.melt_cells(parse_delimited_lines(frame, names, mode=mode), "id", "d", include_key=key, version=4)
        assert rows(got) == rows(want.select(got.columns))
    some = parse_cells(frame, names, "id", "d", mode=mode, columns=["f03", "b"])
    assert rows(some.select("qualifier").distinct()) == ([("b",), ("f03",)] if some.count() else [])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") <= 2 and "Expand" not in plan  # once, and once in the node's long form


def test_order_check_finds_a_break_in_and_between_files(spark):
    from labelforge.operators.ordering import order_check
    df = spark.createDataFrame([(f"{k // 400}", k) for k in range(1000)], "a string, b int")
    path = cells.write_sorted_cells(df.select(F.col("a").alias("rowkey"), F.lpad(F.col("b").cast("string"), 5, "0")
                                              .alias("qualifier")), fresh_path(spark, "order"), 5, cut_rows=True)
    told = order_check(spark, path, ["rowkey", "qualifier"]).first()
    assert (told["rows"], told["breaks_inside"], told["breaks_between"]) == (1000, 0, 0) and told["files"] > 3
    bad = fresh_path(spark, "order")
    df.repartitionByRange(3, "b").sortWithinPartitions(F.desc("b")).write.parquet(bad)
    told = order_check(spark, bad, ["b"]).first()
    assert told["breaks_inside"] == 997 and told["breaks_between"] == 0
    df.repartitionByRange(3, F.desc("b")).sortWithinPartitions("b").write.mode("overwrite").parquet(bad)
    told = order_check(spark, bad, ["b"]).first()
    assert told["breaks_inside"] == 0 and told["breaks_between"] == 2


def test_sorted_files_and_their_check_grow_in_number_not_in_size(spark, monkeypatch):
    from labelforge.operators import ordering
    monkeypatch.setattr(ordering, "SORT_BYTES", 4000, raising=False)
    monkeypatch.setattr(ordering, "PIECE_BYTES", 300, raising=False)
    df = spark.range(2000).select(F.expr("id % 3").cast("string").alias("rowkey"),
                                  F.lpad(F.col("id").cast("string"), 5, "0").alias("qualifier"))
    path = cells.write_sorted_cells(df, fresh_path(spark, "order"), 2, cut_rows=True)
    told = ordering.order_check(spark, path, ["rowkey", "qualifier"]).first()
    assert told["files"] > 10
    assert (told["rows"], told["breaks_inside"], told["breaks_between"]) == (2000, 0, 0)
    told = ordering.order_check(spark, path, ["qualifier"]).first()
    assert told["breaks_inside"] + told["breaks_between"] >= 2
    bad = fresh_path(spark, "order")
    df.coalesce(1).sortWithinPartitions(F.desc("qualifier")).write.parquet(bad)
    check = ordering.order_check(spark, bad, ["qualifier"])
    told = check.first()
    assert (told["rows"], told["files"], told["breaks_inside"], told["breaks_between"]) == (2000, 1, 1999, 0)
    mixed = [7, 7, None, 3, 9, None, None, 8] * 40
    less = sum((b is None and a is not None) or (None not in (a, b) and b < a) for a, b in zip(mixed, mixed[1:]))
    spark.createDataFrame([(x,) for x in mixed], "b int").coalesce(1).write.mode("overwrite").parquet(bad)
    assert ordering.order_check(spark, bad, ["b"]).first()["breaks_inside"] == less
    assert ordering.range_sorted(df, ["qualifier"]).rdd.getNumPartitions() > 10
    ranked = ordering.global_rank(df, ["qualifier"]).collect()
    assert sorted((r["pos"], r["qualifier"]) for r in ranked) == [(k + 1, f"{k:05d}") for k in range(2000)]


def test_search_builds_columns_for_hits_only(spark):
    data = [(str(k), t, f"{t}{k % 5}") for k in range(200) for t in ("a", "b", "c") if (k + ord(t)) % 7]
    path = fresh_path(spark, "search-store")
    profile.write_profile(spark.createDataFrame(data, "userId string, tag string, value string"), path)
    wide = profile.pivot_long(profile.read_profile(spark, path), ["a", "b", "c"])
    columns = ["userId", "c", "a"]
    for method, value in (("eq", "b3"), ("ge", "b2"), ("contains", "4"), ("eq", "none")):
        got = profile.search_profile(spark, path, "b", method, value, columns)
        assert rows(got) == rows(profile.search(wide, "b", method, value, columns))
    assert rows(profile.search_profile(spark, path, "b", "eq", "b1", ["userId", "b"])) == \
        rows(profile.search(wide, "b", "eq", "b1", ["userId", "b"]))


def test_search_methods(spark):
    p = spark.createDataFrame([("1", "rich"), ("2", "poor"), ("3", None)], "userId string, acct string")
    assert rows(profile.search(p, "acct", "eq", "rich"), "userId") == [("1",)]
    assert rows(profile.search(p, "acct", "ne", "rich"), "userId") == [("2",)]
    assert rows(profile.search(p, "acct", "contains", "oo"), "userId") == [("2",)]


def test_packed_tags(spark):
    df = spark.createDataFrame([("1", "gender:m,job:a"), ("2", "gender:f")], "uid string, tags string")
    assert rows(profile.packed_tags(df, "uid", "tags")) == \
        [("1", "gender", "m"), ("1", "job", "a"), ("2", "gender", "f")]


LINES = ["k1\ta\tb", "k2\ta", "k3\ta\tb\tc", "k4\ta\t", "k5\t\t", "k6\ta\tb\t"]


def test_tsv_strict_vs_trailing_trim(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    names = ["id", "f1", "f2"]
    strict = rows(parse_delimited_lines(lines, names, mode="strict"))
    assert strict == [("k1", "a", "b"), ("k4", "a", ""), ("k5", "", "")]
    trimmed = rows(parse_delimited_lines(lines, names, mode="trim_trailing"))
    assert trimmed == [("k1", "a", "b"), ("k6", "a", "b")]


def test_tsv_files_round_trip(spark):
    path = fresh_path(spark, "tsv")
    spark.createDataFrame([(x,) for x in LINES], "value string").write.text(path)
    assert len(read_tsv(spark, path, ["id", "f1", "f2"]).collect()) == 3


def test_cells_melt_sort_get_and_pivot(spark):
    df = spark.createDataFrame([(i, f"n{i}", None if i == 3 else str(i % 2)) for i in range(40)],
                               "id int, name string, flag string")
    melted = cells.melt_cells(df, "id", "detail")
    assert melted.count() == 79  # one null cell dropped
    path = cells.write_sorted_cells(melted, fresh_path(spark, "cells"), num_partitions=4)
    stored = spark.read.parquet(path)
    # every file holds a sorted, contiguous key range and the ranges do not overlap
    by_file = {}
    for r in stored.select("rowkey", F.input_file_name().alias("f")).collect():
        by_file.setdefault(r["f"], []).append(r["rowkey"])
    spans = sorted((v[0], v[-1]) for v in by_file.values())
    assert all(v == sorted(v) for v in by_file.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert rows(cells.get_row(spark, path, "7")) == [("7", "detail", "flag", "1"),
                                                     ("7", "detail", "name", "n7")]
    one = cells.get_row(spark, path, "7")
    assert files_read(one) == 1 and len(os.listdir(path.removeprefix("file:"))) > 4
    assert cells.get_row(spark, path, "99x").collect() == []
    back = cells.pivot_cells(stored, ["name", "flag"])
    assert back.where(F.col("rowkey") == "3").first()["flag"] is None


def test_global_rank_matches_sorted_order(spark):
    df = spark.range(0, 5000).select(F.format_string("%05d", (F.col("id") * 7919) % 5000)
                                     .alias("k"))
    ranked = global_rank(df, ["k"], "pos", num_partitions=7)
    got = sorted((r["k"], r["pos"]) for r in ranked.collect())
    assert got == [(f"{i:05d}", i + 1) for i in range(5000)]


def test_global_rank_of_wide_rows_with_a_hot_key(spark):
    n = 300_000
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("%07d", F.col("id") * 7919 % n))
        .alias("k"), F.col("id").alias("payload"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    ranked = global_rank(df, ["k"], "pos", num_partitions=8)
    assert ranked.agg(F.count_distinct("pos"), F.min("pos"), F.max("pos")).first()[:] == (n, 1, n)
    step = Window.orderBy("pos")
    assert ranked.select((F.lag("k").over(step) <= F.col("k")).alias("ok")).where("not ok").count() == 0
    sizes = ranked.groupBy(F.floor((F.col("pos") - 1) / (n / 8))).count()
    assert sizes.count() == 8


def test_stream_ingest_and_profile_updates(spark):
    from labelforge.plans.runner import MatchSpec
    from labelforge.streaming.ingest import stream_profile_updates, stream_tsv_cells
    src = fresh_path(spark, "s-in")
    spark.createDataFrame([(x,) for x in LINES], "value string").write.text(src)
    sink = fresh_path(spark, "s-out")
    stream_tsv_cells(spark, src, sink, fresh_path(spark, "ck"), ["id", "f1", "f2"],
                     "d").awaitTermination()
    assert spark.read.parquet(sink).count() == 6  # 3 strict rows x 2 cells
    # profile updates from a stream of member rows
    members = fresh_path(spark, "members")
    spark.createDataFrame([(1, "1"), (2, "2")], "id long, job string").write.parquet(members)
    stream = spark.readStream.schema("id long, job string").parquet(members)
    rules = spark.createDataFrame([("1", "student"), ("2", "teacher")], "rule string, name string")
    prof = fresh_path(spark, "prof")
    stream_profile_updates(stream, "id", [MatchSpec("job", "job", rules)], prof,
                           fresh_path(spark, "ck")).awaitTermination()
    assert rows(profile.read_profile(spark, prof), "userId", "tag", "value") == \
        [(1, "job", "student"), (2, "job", "teacher")]


def test_execute_model_run_saves_into_profile(spark):
    from labelforge.plans import catalogue, models
    root = "/root/testdata/sf0.001"
    cat = catalogue.model_catalog(spark, root)
    path = fresh_path(spark, "exec-profile")
    tagged = models.execute(spark, cat, 330, "ratio_range", profile_path=path, field="c_acctbal",
                            tag="acct", key="c_custkey")
    stored = profile.read_profile(spark, path, ["acct"])
    assert stored.count() == tagged.count() > 0


def test_bucketed_profile_table_upsert_moves_only_new_cells(spark):
    from labelforge.operators import profile_table as pt
    path = fresh_path(spark, "ptable")
    name = "ptable_" + path.rsplit("-", 1)[-1]
    pt.create_profile_table(spark, name, path, buckets=4, key_type="STRING")
    old = spark.createDataFrame([("1", "gender", "m"), ("2", "gender", "f"), ("1", "job", "a")],
                                "userId string, tag string, value string")
    pt.replace_tags(old, name)
    new = spark.createDataFrame([("2", "gender", "x"), ("3", "gender", "y"), ("1", "gender", None),
                                 ("3", "gender", "w")], "userId string, tag string, value string")
    before = {f for f, in spark.table(name).select(F.input_file_name()).distinct().collect()}
    pt.upsert_tags(new, name, ["gender"])
    after = {f for f, in spark.table(name).select(F.input_file_name()).distinct().collect()}
    assert before < after  # nothing stored is rewritten
    assert rows(pt.present(spark, name, ["gender", "job"]), "userId", "tag", "value") == [
        ("1", "gender", "m"), ("1", "job", "a"), ("2", "gender", "x"), ("3", "gender", "y")]
    wide = pt.wide_view(spark, name, ["gender", "job"])
    assert rows(wide) == [("1", "m", "a"), ("2", "x", None), ("3", "y", None)]
    assert "Exchange hashpartitioning" not in wide._jdf.queryExecution().executedPlan().toString()
    assert rows(pt.lookup(spark, name, "1", ["gender", "job"]), "tag", "value") == [("gender", "m"), ("job", "a")]


def test_bucketed_profile_lookup_reads_one_bucket(spark):
    from labelforge.operators import profile_table as pt
    path = fresh_path(spark, "ptable")
    name = "ptable_" + path.rsplit("-", 1)[-1]
    pt.create_profile_table(spark, name, path, buckets=4, key_type="STRING")
    cells_ = [(str(i), t, "v") for i in range(40) for t in ("a", "b")]
    pt.replace_tags(spark.createDataFrame(cells_, "userId string, tag string, value string"), name)
    one = pt.lookup(spark, name, "1", ["a", "b"])
    assert rows(one, "userId", "tag") == [("1", "a"), ("1", "b")]
    assert "SelectedBucketsCount: 1 out of 4" in one._jdf.queryExecution().executedPlan().toString()
    pt.replace_tags(spark.createDataFrame([], "userId string, tag string, value string"), name, ["a"])
    assert rows(pt.lookup(spark, name, "1", ["a", "b"]), "tag") == [("b",)]
    pt.compact(spark, name, name + "_c", fresh_path(spark, "ptable"), ["a", "b"], key_type="STRING")
    assert pt.present(spark, name + "_c", ["a", "b"]).count() == 40


def test_stream_restart_from_checkpoint_is_exactly_once(spark):
    from labelforge.streaming.ingest import stream_tsv_cells
    src, sink, ck = fresh_path(spark, "r-in"), fresh_path(spark, "r-out"), fresh_path(spark, "r-ck")
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    lines.write.text(src + "/batch1")

    def run():
        stream_tsv_cells(spark, src + "/*", sink, ck, ["id", "f1", "f2"], "d").awaitTermination()
        return spark.read.parquet(sink).count()

    assert run() == 6
    assert run() == 6  # restart on the same checkpoint: nothing re-processed
    lines.write.text(src + "/batch2")
    assert run() == 12  # only the new file is added
