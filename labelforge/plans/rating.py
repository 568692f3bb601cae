"""Rating jobs (M12-M14, M16): letters -> scores -> features -> classifier -> tag.

Everything is fitted on the training split only (inside a Pipeline), applied to a
separate frame, and the predicted score goes back to a letter (H12) that can be
written to the profile like any other tag (I13).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import MaxAbsScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelforge.functions import scores
from labelforge.operators import aggregates


def scored(df: DataFrame, rating_col: str, scale=scores.SCALE_REGRESSION,
           out: str = "score") -> DataFrame:
    """Add the numeric score of the rating letter (unknown letter -> null row dropped)."""
    return df.withColumn(out, scores.letter_to_score(rating_col, scores.scale(scale))) \
        .where(F.col(out).isNotNull())


def logistic_pipeline(features: list[str] | None, vector_col: str | None = None,
                      label: str = "score", max_iter: int = 100, reg: float = 0.0,
                      elastic_net: float = 0.0) -> Pipeline:
    """I3 + I4 + I8: assemble named features (or take a vector column), max-abs scale,
    multinomial logistic regression on the numeric score."""
    stages = []
    raw = vector_col
    if features:
        stages.append(VectorAssembler(inputCols=features, outputCol="raw_features",
                                      handleInvalid="skip"))
        raw = "raw_features"
    stages += [MaxAbsScaler(inputCol=raw, outputCol="features"),
               LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter,
                                  regParam=reg, elasticNetParam=elastic_net,
                                  family="multinomial")]
    return Pipeline(stages=stages)


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fits; the classifiers keep their own scaled training rows (J1), so nothing else is
    persisted: one copy, of what every iteration reads."""
    return pipeline.fit(train)


def evaluate(model: PipelineModel, data: DataFrame, split: str = "split", label: str = "score",
             prediction: str = "prediction", tolerance: float | None = 1.0) -> DataFrame:
    """I11 + I12: rows, accuracy and (for numeric labels) within-``tolerance`` accuracy per
    value of the ``split`` column, in one pass over ``data``."""
    hit = F.avg(F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0))
    out = [F.count(F.lit(1)).alias("n"), F.round(hit, 6).alias("accuracy")]
    if tolerance is not None:
        near = F.avg(F.when(F.abs(F.col(label) - F.col(prediction)) <= tolerance, 1.0).otherwise(0.0))
        out.append(F.round(near, 6).alias("within_one"))
    return model.transform(data).groupBy(split).agg(*out)


def predicted_tag(model: PipelineModel, apply: DataFrame, key: str,
                  tag: str = "predictedCredit") -> DataFrame:
    """Predictions -> letters -> ``(userId, predictedCredit)`` ready for the profile."""
    return model.transform(apply).select(F.col(key).alias("userId"),
                                         scores.score_to_letter("prediction").alias(tag))


def tree_debug_string(model: PipelineModel) -> str:
    return next(s for s in model.stages if hasattr(s, "toDebugString")).toDebugString


def ratio_correlation(df: DataFrame, ratio_columns: list[str], rating_col: str | None = None,
                      scale=scores.SCALE_ANALYSIS, nulls: str = "drop") -> DataFrame:
    """Pearson matrix of the ratio columns (cast to double) and, when a rating
    column is given, its score -- one aggregation pass."""
    cols = {c: F.col(c).try_cast("double") for c in ratio_columns}
    if rating_col:
        cols["score"] = scores.letter_to_score(rating_col, scores.scale(scale))
    return aggregates.corr_matrix(df, cols, nulls=nulls)
