"""Model training and auditing.

Logistic regression (Newton steps) with 'balanced' class weights and boosted trees
(pyspark.ml) weighted by the negative/positive ratio, their test-set predictions, feature
importances, a leak flag for a dominating feature and the ablation without it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tessera.functions.numeric import is_finite
from tessera.operators import newton
from tessera.operators.metrics import classification_report, roc_auc
from tessera.schema import GBT_PARAMS, LR_MAX_ITER, RANDOM_STATE
from tessera.sources.stage import written

LEAK_SHARE = 0.5
# Stands for a missing feature value in the linear model: below every measure.
MISSING = -1.0
# Stand for a missing value in the two columns that a tree sees of a feature: below and above every value.
LOWEST, HIGHEST = -1e300, 1e300


@dataclass
class FittedModel:
    name: str
    features: list[str]
    predictions: DataFrame  # test rows: key, label, prediction, probability
    importances: list[tuple[str, float]] = field(default_factory=list)
    model: object | None = None  # the fitted pyspark.ml or linear model (absent when loaded from storage)


def _known(name: str) -> F.Column:
    """A feature as a double; null where it is NULL, NaN or infinite."""
    v = F.col(name).cast("double")
    return F.when(is_finite(v), v)


def _output(df: DataFrame, key: str, target: str, prediction: F.Column, probability: F.Column) -> DataFrame:
    return df.select(key, F.col(target).cast("int").alias("label"), prediction.cast("int").alias("prediction"),
                     probability.alias("probability"))


def fit_logistic(train: DataFrame, test: DataFrame, features: list[str], target: str, weight: str,
                 key: str = "obs_key", max_iter: int = LR_MAX_ITER, c: float = 1.0, tol: float = 1e-10) -> FittedModel:
    """L2 logistic regression: the per-sample-summed objective ``0.5*||w||^2 + C * sum_i w_i * loss_i``
    on the raw features, by Newton steps (:mod:`newton`).  Missing values are :data:`MISSING`."""
    rows = train.select(*[F.coalesce(_known(f), F.lit(MISSING)).alias(f"_f{i}") for i, f in enumerate(features)], target, weight)
    model = newton.fit(rows, [f"_f{i}" for i in range(len(features))], target, weight, c=c, max_iter=max_iter, tol=tol)
    model.features = list(features)
    m = model.margin(lambda f: F.coalesce(_known(f), F.lit(MISSING)))
    preds = _output(test.withColumn("_margin", m), key, target, F.col("_margin") > 0, newton.sigmoid(F.col("_margin")))
    return FittedModel("logistic_regression", features, preds, [(f, abs(w)) for f, w in zip(features, model.coefficients)], model)


def _gaps(train: DataFrame, features: list[str]) -> list[str]:
    """Features that are missing in some training row: one aggregate."""
    row = train.agg(*[F.max(_known(f).isNull()).alias(f"_m{i}") for i, f in enumerate(features)]).first()
    return [f for f, gap in zip(features, row) if gap]


def _both_ways(df: DataFrame, features: list[str], gaps: list[str]) -> DataFrame:
    """``df`` with the vector ``features``: every feature with its missing values below all others,
    then each of ``gaps`` again with them above all others."""
    filled = F.struct(*[F.coalesce(_known(f), F.lit(LOWEST)).alias(f"l{i}") for i, f in enumerate(features)],
                      *[F.coalesce(_known(f), F.lit(HIGHEST)).alias(f"h{i}") for i, f in enumerate(gaps)])
    names = [f"_features.l{i}" for i in range(len(features))] + [f"_features.h{i}" for i in range(len(gaps))]
    return VectorAssembler(inputCols=names, outputCol="features").transform(df.withColumn("_features", filled)).drop("_features")


def fit_boosted_trees(name: str, train: DataFrame, test: DataFrame, features: list[str], target: str, weight: str,
                      key: str = "obs_key", n_estimators: int = GBT_PARAMS["n_estimators"],
                      max_depth: int = GBT_PARAMS["max_depth"], learning_rate: float = GBT_PARAMS["learning_rate"],
                      seed: int = RANDOM_STATE) -> FittedModel:
    """Gradient-boosted trees (logistic loss), weighted rows, fixed seed.

    Missing values need no filling: a feature with gaps in training is offered twice, its missing
    values below and above all others, so each split learns the side that missing rows go to from
    the gain of both.  The importance of a feature is that of both forms.  A value that is missing
    in no training row goes with the least values.
    """
    gaps = _gaps(train, features)
    gbt = GBTClassifier(featuresCol="features", labelCol=target, weightCol=weight, maxIter=n_estimators,
                        maxDepth=max_depth, stepSize=learning_rate, seed=seed, cacheNodeIds=True,
                        checkpointInterval=10, featureSubsetStrategy="all")
    model = gbt.fit(_both_ways(train, features, gaps))
    scored = model.transform(_both_ways(test, features, gaps))
    preds = _output(scored, key, target, F.col("prediction"), vector_to_array("probability")[1])
    imp = model.featureImportances.toArray().tolist()
    above = dict(zip(gaps, imp[len(features):]))
    return FittedModel(name, features, preds, [(f, v + above.get(f, 0.0)) for f, v in zip(features, imp)], model)


def importance_frame(spark: SparkSession, fitted: FittedModel) -> DataFrame:
    """(feature, importance) sorted by importance, largest first."""
    rows = [(f, float(v)) for f, v in fitted.importances]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), F.asc("feature"))


def leak_flag(importances: DataFrame, share: float = LEAK_SHARE) -> DataFrame:
    """Features whose importance share reaches ``share`` — a red flag for target leakage."""
    total = F.sum("importance").over(Window.partitionBy())  # one row per feature
    return (
        importances.select("feature", "importance", (F.col("importance") / total).alias("share"))
        .withColumn("leak_suspect", F.col("share") >= share)
        .orderBy(F.desc("share"))
    )


def evaluate(fitted: FittedModel) -> DataFrame:
    """One row of metrics for a fitted model on its test rows."""
    preds = fitted.predictions
    none = F.lit(None).cast("double")
    auc = roc_auc(preds, "label", "probability").select(F.lit("roc_auc").alias("label"), none.alias("precision"), none.alias("recall"),
                                                        F.col("roc_auc").alias("f1_score"))
    rep = classification_report(preds, "label", "prediction").select("label", "precision", "recall", "f1_score")

    def cell(label: str, column: str, alias: str) -> F.Column:
        return F.max(F.when(F.col("label") == label, F.col(column))).alias(alias)

    # The report's few rows and the area as one more, read off into one row without a join.
    return rep.unionByName(auc).agg(
        cell("roc_auc", "f1_score", "roc_auc"), cell("accuracy", "f1_score", "accuracy"),
        cell("Breakout Hit", "precision", "precision_pos"), cell("Breakout Hit", "recall", "recall_pos"),
        cell("Breakout Hit", "f1_score", "f1_pos"),
    ).select(F.lit(fitted.name).alias("model"), F.lit(len(fitted.features)).alias("n_features"),
             "roc_auc", "accuracy", "precision_pos", "recall_pos", "f1_pos")


def persist(df: DataFrame) -> DataFrame:
    """Cache training input across the iterations of a fit (recomputed from lineage if lost)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def save(spark: SparkSession, fitted: FittedModel, root: str) -> FittedModel:
    """Write a fitted model's outputs under ``root``: scored test rows, importances
    (in feature order) and the model; ``_importances`` is written last
    and marks the folder complete.  Returns the model reading its predictions back."""
    fitted.predictions.write.mode("overwrite").parquet(f"{root}/predictions")
    if isinstance(fitted.model, newton.LinearModel):
        m = fitted.model
        weights = [*zip(m.features, m.coefficients), (None, m.intercept)]  # the intercept has no name
        spark.createDataFrame(weights, "feature string, weight double").coalesce(1).write.mode("overwrite").parquet(f"{root}/model")
    elif fitted.model is not None:
        fitted.model.write().overwrite().save(f"{root}/model")
    rows = [(i, f, float(v)) for i, (f, v) in enumerate(fitted.importances)]
    spark.createDataFrame(rows, "position int, feature string, importance double") \
        .coalesce(1).write.mode("overwrite").parquet(f"{root}/_importances")
    return FittedModel(fitted.name, fitted.features, spark.read.parquet(f"{root}/predictions"),
                       fitted.importances, fitted.model)


def load(spark: SparkSession, name: str, root: str) -> FittedModel | None:
    """A model saved by :func:`save`, or None when the folder is absent or incomplete."""
    if not written(spark, f"{root}/_importances"):  # a storage error is raised, never read as absence
        return None
    imp = spark.read.parquet(f"{root}/_importances").orderBy("position").collect()  # one row per feature
    preds = spark.read.parquet(f"{root}/predictions")
    return FittedModel(name, [r["feature"] for r in imp], preds, [(r["feature"], r["importance"]) for r in imp])
