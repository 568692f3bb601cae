"""Spark ML building blocks (I1-I14).  Fits run distributed (tree aggregates);
only model parameters and label lists come back to the driver."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import (IndexToString, MaxAbsScaler, Normalizer, StringIndexer,
                                VectorAssembler, VectorIndexer)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelforge.operators.replace import key_pick


# Distinct labels an indexer brings to the driver, at most; more is an error.
MAX_LABELS = 100_000


def index_labels(df: DataFrame, input_col: str, output_col: str = "label",
                 order: str = "frequencyDesc", handle_invalid: str = "error"):
    """StringIndexer (frequency descending, ties alphabetical) -> (model, frame).

    ``handle_invalid``: what null labels do: ``error`` (the reference's default) or ``skip``
    (their rows go).  They never become a class."""
    if handle_invalid not in ("error", "skip"):
        raise ValueError("handle_invalid must be 'error' or 'skip'")
    if df.select(input_col).distinct().limit(MAX_LABELS + 1).count() > MAX_LABELS:
        raise ValueError(f"{input_col} has over {MAX_LABELS} values and is no label")
    model = StringIndexer(inputCol=input_col, outputCol=output_col,
                          stringOrderType=order, handleInvalid=handle_invalid).fit(df)
    return model, model.transform(df)


def restore_labels(df: DataFrame, labels: list[str], input_col: str = "prediction",
                   output_col: str = "predictedLabel") -> DataFrame:
    """IndexToString with the indexer's label list."""
    return IndexToString(inputCol=input_col, outputCol=output_col, labels=labels).transform(df)


def assemble(df: DataFrame, columns: list[str], output_col: str = "raw_features",
             handle_invalid: str = "skip") -> DataFrame:
    """Numeric columns -> vector (rows with null/NaN features skipped by default)."""
    return VectorAssembler(inputCols=columns, outputCol=output_col,
                           handleInvalid=handle_invalid).transform(df)


def max_abs_scale(df: DataFrame, input_col: str = "raw_features",
                  output_col: str = "features") -> DataFrame:
    """I4: MaxAbsScaler fitted on ``df``."""
    return MaxAbsScaler(inputCol=input_col, outputCol=output_col).fit(df).transform(df)


def l2_normalize(df: DataFrame, input_col: str, output_col: str = "norm_features",
                 p: float = 2.0) -> DataFrame:
    """Normalizer(p)."""
    return Normalizer(inputCol=input_col, outputCol=output_col, p=p).transform(df)


def vector_category_kinds(df: DataFrame, input_col: str, max_categories: int = 20) -> dict:
    """Which vector slots VectorIndexer treats as categorical -> {slot: n_values}."""
    model = VectorIndexer(inputCol=input_col, outputCol="_idx",
                          maxCategories=max_categories).fit(df)
    return {int(k): len(v) for k, v in model.categoryMaps.items()}


def array_features(col) -> Column:
    """array<float|double> -> ML vector."""
    return array_to_vector(F.col(col) if isinstance(col, str) else col)


def vector_elements(col) -> Column:
    return vector_to_array(F.col(col) if isinstance(col, str) else col)


def hash_split(df: DataFrame, key: str, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Repeatable split on a hash of the key's text (the same row lands on the same side
    on every run and every task retry, unlike an unseeded ``randomSplit``)."""
    bucket = key_pick(key, 100)
    return df.where(bucket < train_pct), df.where(bucket >= train_pct)


def split_label(key: str, train_pct: int = 80) -> Column:
    return F.when(key_pick(key, 100) < train_pct, F.lit("train")).otherwise(F.lit("test"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction",
             digits: int | None = 6) -> DataFrame:
    """Share of rows with prediction == label (MulticlassClassificationEvaluator
    'accuracy'), as a one-row frame."""
    acc = F.avg(F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0))
    return df.agg((F.round(acc, digits) if digits is not None else acc).alias("accuracy"))


def tolerance_accuracy(df: DataFrame, prediction, score, tol: float = 1.0,
                       digits: int | None = 6) -> DataFrame:
    """Share of rows with |prediction - score| <= tol."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    s = F.col(score) if isinstance(score, str) else score
    acc = F.avg(F.when(F.abs(p - s) <= F.lit(tol), 1.0).otherwise(0.0))
    return df.agg((F.round(acc, digits) if digits is not None else acc).alias("accuracy"))


def fit_logistic(train: DataFrame, features: str = "features", label: str = "label",
                 max_iter: int = 100, reg: float = 0.0, elastic_net: float = 0.0,
                 standardize: bool = True, family: str = "multinomial"):
    """I8: LogisticRegression.  The training frame is persisted (J1) because every
    iteration re-reads it."""
    cached = train.select(features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                                  regParam=reg, elasticNetParam=elastic_net,
                                  standardization=standardize, family=family).fit(cached)
    finally:
        cached.unpersist()


def _loss_gradients(features: str, label: str, probability: str, classes: int):
    """Per task: sums over its rows of (p_k - y_k) x_j, and of the same with the class shares in
    the place of p; the last slot is the intercept's."""
    def sums(batches):
        import numpy as np
        import pyarrow as pa
        total = None
        for batch in batches:
            x, p = (batch.column(c).flatten().to_numpy().reshape(batch.num_rows, -1) for c in (features, probability))
            y = batch.column(label).to_numpy(zero_copy_only=False).astype(int)
            x = np.column_stack([x, np.ones(len(x))])
            hot = np.zeros((len(x), classes))
            hot[np.arange(len(x)), y] = 1
            own = np.stack([(p - hot).T @ x, hot.T @ x, np.broadcast_to(x.sum(axis=0), (classes, x.shape[1]))])
            total = own if total is None else total + own
        if total is not None:
            k, j = np.indices(total.shape[1:])
            yield pa.RecordBatch.from_pydict({
                "k": pa.array(k.ravel().astype(np.int32)), "j": pa.array(j.ravel().astype(np.int32)),
                **{c: pa.array(total[i].ravel()) for i, c in enumerate(("g", "sy", "sx"))}})
    return sums


def optimality(model, train: DataFrame, features: str = "features", label: str = "label",
               reg: float = 0.0) -> DataFrame:
    """First-order optimality of a fitted multinomial model, as a one-row frame: ``n`` rows,
    ``gradient`` and ``start``, the largest component of the loss's gradient at the fit and at the
    best model without features (class shares), each per row and in units of the feature's
    deviation, and their ``ratio``, which a fit brings near to zero.

    The gradient is one aggregate over ``train`` (rows and classes of the fit); with ``reg`` the
    penalty's part, on coefficients in those units, is added (L2)."""
    classes = model.numClasses
    scored = model.transform(train.select(features, F.col(label).cast("double").alias(label)))
    arrays = scored.select(vector_to_array(features).alias("x"), F.col(label).alias("y"),
                           vector_to_array("probability").alias("p"))
    sums = arrays.mapInArrow(_loss_gradients("x", "y", "p", classes), "k int, j int, g double, sy double, sx double") \
        .groupBy("k", "j").agg(*[F.sum(c).alias(c) for c in ("g", "sy", "sx")])
    spread = scored.select(Summarizer.metrics("std", "count").summary(F.col(features)).alias("s")).first()["s"]
    width, n = len(spread["std"]), spread["count"]
    # one number per feature and coefficient: the size of the model, not of the data
    unit = F.array(*[F.lit(float(v) if v > 0 else 1.0) for v in spread["std"]], F.lit(1.0))
    coefficients = model.coefficientMatrix.toArray()
    held = F.array(*[F.array(*[F.lit(float(reg * c * (v if v > 0 else 0.0))) for c, v in zip(row, spread["std"])],
                             F.lit(0.0)) for row in coefficients])
    share = F.col("sy0") / n
    whole = sums.where(F.col("j") == width).select("k", F.col("sy").alias("sy0"))
    scaled = sums.join(F.broadcast(whole), "k").select(
        F.abs(F.col("g") / n / F.get(unit, F.col("j")) + F.get(F.get(held, F.col("k")), F.col("j"))).alias("gradient"),
        (F.abs(share * F.col("sx") - F.col("sy")) / n / F.get(unit, F.col("j"))).alias("start"))
    return scaled.agg(F.lit(n).cast("long").alias("n"), F.max("gradient").alias("gradient"), F.max("start").alias("start")) \
        .withColumn("ratio", F.col("gradient") / F.col("start"))


def tree_nodes(model) -> list[dict]:
    """The nodes of a fitted tree: id, its condition's feature and threshold, left, right, and
    the way from the root as (node, went left); a leaf has no feature."""
    out: list[dict] = []

    def add(node, way):
        own = {"id": len(out), "way": way, "feature": None}
        out.append(own)
        if node.subtreeDepth() > 0:
            own |= {"feature": node.split().featureIndex(), "threshold": node.split().threshold()}
            own["left"] = add(node.leftChild(), [*way, (own["id"], True)])
            own["right"] = add(node.rightChild(), [*way, (own["id"], False)])
        return own["id"]
    add(model._java_obj.rootNode(), [])
    return out


def split_check(model, train: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """Every split of a fitted tree on continuous features against all others: node, n, feature,
    threshold, chosen and best (purity of the two sides, the sum over classes of squared counts
    over rows; the greater, the less Gini impurity).

    One aggregate counts the rows of each node by feature, value and class, for all nodes at
    once; running sums over a feature's distinct values then give the purity of every
    threshold.  For features of few distinct values (no more than the tree's bins)."""
    nodes, classes = tree_nodes(model), model.numClasses
    inner = [v for v in nodes if v["feature"] is not None]
    if not inner:
        return train.sparkSession.createDataFrame(
            [], "node int, n long, feature int, threshold double, chosen double, best double")
    x = F.col("x")

    def reached(node):
        steps = [(x[nodes[k]["feature"]] <= nodes[k]["threshold"]) == F.lit(left) for k, left in node["way"]]
        return reduce(lambda a, b: a & b, steps, F.lit(True))
    rows = train.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"))
    at = rows.select("x", "y", F.explode(F.array_compact(F.array(*[
        F.when(reached(v), F.lit(v["id"])) for v in inner]))).alias("node"))
    counts = at.select("node", "y", F.posexplode("x").alias("j", "v")).groupBy("node", "j", "v") \
        .agg(*[F.sum((F.col("y") == k).cast("long")).alias(f"c{k}") for k in range(classes)])
    # distinct values of one feature in one node: no more than the tree has bins
    whole = Window.partitionBy("node", "j")
    below = whole.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = [F.sum(f"c{k}").over(below) for k in range(classes)]
    every = [F.sum(f"c{k}").over(whole) for k in range(classes)]
    sides = counts.select("node", "j", "v", *[a.alias(f"l{k}") for k, a in enumerate(left)],
                          *[a.alias(f"a{k}") for k, a in enumerate(every)])
    n_left, n_all = (reduce(lambda a, b: a + b, [F.col(f"{c}{k}") for k in range(classes)]) for c in "la")
    square = lambda cols: reduce(lambda a, b: a + b, [c.cast("double") * c for c in cols])
    purity = F.when(n_left < n_all, square([F.col(f"l{k}") for k in range(classes)]) / n_left + square(
        [F.col(f"a{k}") - F.col(f"l{k}") for k in range(classes)]) / (n_all - n_left))
    told = F.create_map(*[F.lit(z) for v in inner for z in (v["id"], v["feature"])])
    cut = F.create_map(*[F.lit(z) for v in inner for z in (v["id"], float(v["threshold"]))])
    scored = sides.select("node", "j", "v", n_all.alias("n"), purity.alias("purity"))
    chosen = F.when((F.col("j") == told[F.col("node")]) & (F.col("v") <= cut[F.col("node")]), F.struct("v", "purity"))
    return scored.groupBy("node").agg(F.max("n").alias("n"), F.max(chosen)["purity"].alias("chosen"),
                                      F.max("purity").alias("best")) \
        .select("node", "n", told[F.col("node")].alias("feature"), cut[F.col("node")].alias("threshold"), "chosen", "best")


def tree_pipeline(label_in: str, vector_col: str | None = None, columns: list[str] | None = None,
                  max_categories: int = 20, max_depth: int = 5, max_bins: int = 32,
                  seed: int = 42, handle_invalid: str = "error") -> Pipeline:
    """Label indexer (I1), named ``columns`` assembled (I3) or a ``vector_col``,
    feature indexer (I6), decision tree (I9).  The label indexer is fitted inside the
    pipeline, so its labels come from the training split only; ``handle_invalid`` is what
    null and unseen labels do (``error`` or ``skip``)."""
    stages, raw = [], vector_col
    if columns:
        stages.append(VectorAssembler(inputCols=columns, outputCol="raw_features", handleInvalid="skip"))
        raw = "raw_features"
    return Pipeline(stages=stages + [
        StringIndexer(inputCol=label_in, outputCol="indexedLabel", handleInvalid=handle_invalid),
        VectorIndexer(inputCol=raw, outputCol="indexedFeatures",
                      maxCategories=max_categories, handleInvalid="keep"),
        DecisionTreeClassifier(labelCol="indexedLabel", featuresCol="indexedFeatures",
                               maxDepth=max_depth, maxBins=max_bins, seed=seed)])


def with_label_restore(model: PipelineModel) -> PipelineModel:
    """The fitted pipeline with its predictions as labels again, in predictedLabel.  The
    label indexer only serves training and goes, so that unlabelled rows can be scored."""
    indexer = next(s for s in model.stages if hasattr(s, "labels"))
    rest = [s for s in model.stages if s is not indexer]
    return PipelineModel(stages=rest + [IndexToString(
        inputCol="prediction", outputCol="predictedLabel", labels=indexer.labels)])


def save_model(model, path: str) -> str:
    """Persist a fitted model or pipeline model (overwrites)."""
    model.write().overwrite().save(path)
    return path
