import hashlib
import random
from collections import Counter

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegressionModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from labelforge.functions import dates, scores
from labelforge.functions.casts import cast_all_double
from labelforge.operators import aggregates, learning
from labelforge.operators.replace import replace_not_in, replace_out_of_range
from labelforge.session import fresh_path
from tests.conftest import rows


def test_letter_scales_and_letter_back(spark):
    df = spark.createDataFrame([(x,) for x in scores.RATING_LETTERS + ("ZZ",)], "r string")
    out = dict(rows(df.select("r", scores.letter_to_score(
        "r", scores.scale(scores.SCALE_REGRESSION)).alias("s"))))
    assert out["AAA"] == 10.0 and out["AA"] == 9.0 and out["D"] == 4.0 and out["ZZ"] is None
    back = df.select(scores.letter_to_score("r", scores.scale(scores.SCALE_REGRESSION))
                     .alias("s")).select(scores.score_to_letter("s").alias("l"))
    letters = [r[0] for r in back.collect()]
    assert letters[:7] == ["AAA", "AA", "A", "BBB", "BB", "B", "CCC"]
    assert letters[-1] == ""  # unknown letter -> null score -> empty letter


def test_tolerance_flag_and_accuracy(spark):
    df = spark.createDataFrame([(8.0, 9.0), (8.0, 10.0), (7.0, 7.0)], "p double, s double")
    assert [r[0] for r in df.select(scores.tolerance_flag("p", "s")).collect()] == [0.0, 1.0, 0.0]
    assert learning.tolerance_accuracy(df, "p", "s").first()[0] == round(2 / 3, 6)


def test_cast_all_double_and_date_helpers(spark):
    df = spark.createDataFrame([("7", "1.5", "x", "1982-01-11")], "id string, a string, b string, d string")
    out = cast_all_double(df.drop("d")).first()
    assert (out["id"], out["a"], out["b"]) == ("7", 1.5, None)
    r = df.select(dates.date_text_to_int("d").alias("i"),
                  dates.date_text_to_int(F.lit("19x2")).alias("bad"),
                  dates.days_since("d", "1982-01-21").alias("n"),
                  dates.window_start("2019-09-01", 1, "year").alias("w")).first()
    assert (r["i"], r["bad"], r["n"], r["w"]) == (19820111, None, 10, "2018-08-31")


def test_key_hash_replacement_is_repeatable(spark):
    df = spark.createDataFrame([(1, 960, "visa"), (2, 5, "cod")], "k long, m long, p string")
    a = df.select(replace_out_of_range("m", "k", 950).alias("m"),
                  replace_not_in("p", scores.PAYMENT_CODES, "k").alias("p")).collect()
    mix = int(hashlib.md5(b"1").hexdigest()[:8], 16)
    assert [tuple(r) for r in a] == [(mix % 950 + 1, scores.PAYMENT_CODES[mix % 4]), (5, "cod")]


def test_key_hash_takes_any_key_and_spreads_it(spark):
    big = spark.range(1000).select((F.col("id") + 1700000000000000000).alias("k"))
    text = spark.range(1000).select(F.concat(F.lit("u-"), F.col("id")).alias("k"))
    steps = spark.range(1000).select((F.col("id") * 100).alias("k"))
    for df in (big, text, steps):
        train, test = learning.hash_split(df, "k", 80)
        assert abs(train.count() / 1000 - 0.8) < 0.04 and train.count() + test.count() == 1000
    wide = spark.range(100_000).select((F.col("id") * 100).alias("k"))
    assert abs(learning.hash_split(wide, "k", 80)[0].count() / 100_000 - 0.8) < 0.02
    assert learning.hash_split(spark.createDataFrame([(None,)], "k long"), "k")[0].count() in (0, 1)


def test_null_labels_are_an_error_or_skipped_never_a_class(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    with pytest.raises(Exception, match="NULL"):
        learning.index_labels(df, "c")[1].collect()
    model, out = learning.index_labels(df, "c", handle_invalid="skip")
    assert rows(out) == [(1, "a", 0.0), (2, "b", 1.0)] and list(model.labels) == ["a", "b"]


def test_corr_matrix_nulls_constants_and_offsets(spark):
    df = spark.createDataFrame([(1e9 + 1, 1.0, 5.0, None), (1e9 + 2, None, 5.0, 1.0), (1e9 + 3, 3.0, 5.0, None),
                                (1e9 + 4, 9.0, 5.0, None)], "a double, b double, c double, d double")
    names = {"a": "a", "b": "b", "c": "c", "d": "d"}
    out = {(r["a"], r["b"]): r["r"] for r in aggregates.corr_matrix(df, names).collect()}
    want = df.where("b is not null").agg(F.round(F.corr("a", "b"), 6)).first()[0]
    assert out["a", "b"] == out["b", "a"] == want
    assert out["a", "c"] is None and out["c", "c"] is None and out["a", "d"] is None
    zero = {(r["a"], r["b"]): r["r"] for r in aggregates.corr_matrix(df, names, nulls="zero").collect()}
    want = df.fillna(0.0).agg(F.round(F.corr("b", "d"), 6)).first()[0]
    assert zero["b", "d"] == want
    upper = aggregates.corr_matrix(df, names, pairs="upper").select("a", "b").collect()
    assert sorted(map(tuple, upper)) == [("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("c", "d")]


def test_corr_matrix_single_pass(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1, float((-1) ** i)) for i in range(50)],
                               "a double, b double, c double")
    out = {(r["a"], r["b"]): r["r"] for r in
           aggregates.corr_matrix(df, {"a": "a", "b": "b", "c": "c"}).collect()}
    assert out[("a", "b")] == 1.0 and out[("a", "a")] == 1.0 and len(out) == 9


def test_corr_matrix_reads_once_and_bears_offsets(spark):
    rnd = random.Random(2)
    data = [(x := rnd.gauss(0, 1), 0.5 * x + rnd.gauss(0, 1), rnd.random()) for _ in range(4000)]
    plain = spark.createDataFrame(data, "a double, b double, c double").repartition(7)
    moved = plain.withColumn("a", F.col("a") + 1e9).withColumn("c", F.col("c") - 1e9)
    for df, digits in ((plain, 9), (moved, 5)):
        out = {(r["a"], r["b"]): r["r"] for r in aggregates.corr_matrix(df, {k: k for k in "abc"}, digits=None).collect()}
        for a, b in ("ab", "ac", "bc"):
            assert round(out[a, b], digits) == round(plain.agg(F.corr(a, b)).first()[0], digits)
    path = fresh_path(spark, "corr")
    plain.write.parquet(path)
    plan = aggregates.corr_matrix(spark.read.parquet(path), {"a": "a", "b": "b"}, pairs="upper") \
        ._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_gradient_vanishes_at_a_fit_and_not_on_shuffled_labels(spark):
    rnd = random.Random(3)
    data = [(k, Vectors.dense([rnd.gauss(k % 3 == 0, 1), 50 * rnd.gauss(k % 3 == 1, 1), 0.0]), float(k % 3)) for k in range(600)]
    df = spark.createDataFrame(data, ["id", "features", "label"])
    model = learning.fit_logistic(df, max_iter=100)
    fit = learning.optimality(model, df).first()
    assert fit["n"] == 600 and fit["ratio"] < 0.01
    shuffled = df.withColumn("label", F.pmod(F.xxhash64("id"), F.lit(3)).cast("double"))
    assert learning.optimality(learning.fit_logistic(shuffled, max_iter=100), df).first()["ratio"] > 0.3
    assert learning.optimality(learning.fit_logistic(df, max_iter=1), df).first()["ratio"] > 0.05
    held = learning.fit_logistic(df, max_iter=200, reg=0.1)
    assert learning.optimality(held, df, reg=0.1).first()["ratio"] < 0.01
    assert learning.optimality(held, df).first()["ratio"] > 0.05


def test_every_split_is_compared_with_all_thresholds(spark):
    rnd = random.Random(5)
    points = [(rnd.randrange(9), rnd.randrange(5), rnd.randrange(7)) for _ in range(900)]
    data = [(Vectors.dense(list(map(float, p))), float((p[0] > 4) + (p[1] > 2) * (p[2] % 2))) for p in points]
    df = spark.createDataFrame(data, ["features", "label"])
    model = DecisionTreeClassifier(maxDepth=4, maxBins=32, seed=1).fit(df)
    checked = learning.split_check(model, df).collect()
    inner = [v for v in learning.tree_nodes(model) if v["feature"] is not None]
    assert len(checked) == len(inner) > 4 and max(r["n"] for r in checked) == 900
    assert all(abs(r["chosen"] - r["best"]) <= 1e-9 * r["best"] for r in checked)

    def purity(rows):
        return sum(n * n for n in Counter(y for _, y in rows).values()) / len(rows) if rows else 0

    def best(rows):
        return max(purity([r for r in rows if r[0][j] <= t]) + purity([r for r in rows if r[0][j] > t])
                   for j in range(3) for t in {r[0][j] for r in rows} if any(r[0][j] > t for r in rows))
    assert abs(best(data) - next(r["best"] for r in checked if r["n"] == 900)) < 1e-6
    wrong = df.withColumn("label", F.pmod(F.xxhash64("features"), F.lit(2)).cast("double"))
    assert any(r["chosen"] < r["best"] * (1 - 1e-9) for r in learning.split_check(model, wrong).collect())


def _separable(spark):
    data = [(i, Vectors.dense([float(i % 3) * 5 + (i % 7) * 0.1, float(i % 3) * -3.0]),
             float(i % 3)) for i in range(300)]
    return spark.createDataFrame(data, ["id", "features", "label"])


def test_logistic_accuracy_floor_and_save_load(spark):
    df = _separable(spark)
    train, test = learning.hash_split(df, "id", 80)
    model = learning.fit_logistic(train, max_iter=50)
    pred = model.transform(test)
    assert learning.accuracy(pred, "label", "prediction").first()[0] >= 0.95
    path = learning.save_model(model, fresh_path(spark, "lr"))
    loaded = LogisticRegressionModel.load(path)
    a = model.transform(test).select("id", "prediction")
    b = loaded.transform(test).select("id", "prediction")
    assert rows(a) == rows(b)


def test_tree_pipeline_restores_labels(spark):
    df = _separable(spark).withColumn("category", F.concat(F.lit("c"), F.col("label").cast("int")))
    train, test = learning.hash_split(df, "id", 70)
    model = learning.with_label_restore(
        learning.tree_pipeline("category", "features", max_depth=3).fit(train))
    pred = model.transform(test)
    acc = pred.agg(F.avg((F.col("predictedLabel") == F.col("category")).cast("double"))).first()[0]
    assert acc >= 0.95


def test_hash_split_is_stable(spark):
    df = spark.range(1000)
    a, b = learning.hash_split(df, "id", 80)
    assert a.count() + b.count() == 1000
    assert rows(a) == rows(learning.hash_split(df, "id", 80)[0])
