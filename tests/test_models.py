"""Model layer on the smallest tables with a short boosting run (properties, not figures)."""

from pyspark.sql import functions as F

from tessera.operators import features, models
from tessera.plans import queries as Q
from tessera.schema import TARGET_COL


def test_leak_is_found_and_ablation_runs(spark, sf_small):
    prep = Q.prepared(spark, sf_small)
    train, test = Q._train_test(spark, sf_small)
    w = features.class_weights(train, TARGET_COL).first().asDict()
    tr = features.with_weight(train, TARGET_COL, w, "pos_ratio")
    v1 = models.fit_boosted_trees("gbt_v1", tr, test, prep.features_v1, TARGET_COL, "weight", n_estimators=5)
    imp = models.importance_frame(spark, v1)
    flags = models.leak_flag(imp).first()
    assert flags["feature"] == "is_aaa" and flags["leak_suspect"]
    v2 = models.fit_boosted_trees("gbt_v2", tr, test, prep.features_v2, TARGET_COL, "weight", n_estimators=5)
    assert "is_aaa" not in v2.features
    m = models.evaluate(v2).first()
    assert 0.5 <= m["roc_auc"] <= 1.0
    assert v2.predictions.count() == test.count()


def test_logistic_regression_balanced(spark, sf_small):
    prep = Q.prepared(spark, sf_small)
    train, test = Q._train_test(spark, sf_small)
    w = features.class_weights(train, TARGET_COL).first().asDict()
    assert w["weight_positive"] > 1 > w["weight_negative"]
    tr = features.with_weight(train, TARGET_COL, w, "balanced")
    lr = models.fit_logistic(tr, test, prep.features_v1, TARGET_COL, "weight", max_iter=50)
    m = models.evaluate(lr).first()
    assert m["roc_auc"] > 0.5
    assert lr.predictions.filter(F.col("probability").isNull()).count() == 0


def test_missing_feature_values_are_accepted(spark):
    rows = [(str(i), i % 2, None if i % 5 == 0 else float(i % 2), float("nan") if i % 7 == 0 else 1.0, 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "obs_key string, y int, a double, b double, weight double")
    for fitted in (models.fit_logistic(df, df, ["a", "b"], "y", "weight", max_iter=20),
                   models.fit_boosted_trees("t", df, df, ["a", "b"], "y", "weight", n_estimators=2)):
        assert fitted.predictions.filter("probability between 0 and 1").count() == 60
        assert models.evaluate(fitted).first()["accuracy"] > 0.8


def test_evaluation_plans_no_nested_loop(spark):
    preds = spark.createDataFrame([("a", 1, 1, 0.9), ("b", 0, 0, 0.1)], "obs_key string, label int, prediction int, probability double")
    out = models.evaluate(models.FittedModel("m", ["x"], preds))
    p = out._jdf.queryExecution().toString()
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert out.first().asDict() == {"model": "m", "n_features": 1, "roc_auc": 1.0, "accuracy": 1.0, "precision_pos": 1.0,
                                    "recall_pos": 1.0, "f1_pos": 1.0}


def test_feature_list_refuses_unknown_drops():
    import pytest

    assert features.feature_list(["a", "b", "y"], ["a"], "y") == ["b"]
    with pytest.raises(KeyError):
        features.feature_list(["a", "b", "y"], ["a", "zz"], "y")


def test_models_are_fitted_on_the_whole_train_part(spark, sf_small, monkeypatch):
    """Also where the train part has more rows than the workflow's sample."""
    monkeypatch.setattr(Q, "SAMPLE_SIZE", 500)
    monkeypatch.setattr(Q, "_FITTED", {})
    monkeypatch.setattr(models, "load", lambda *a: None)
    monkeypatch.setattr(models, "save", lambda spark, fitted, root: fitted)
    seen = {}

    def fit(name, train, feats):
        seen[name] = sorted(tuple(r[:-1]) for r in train.select(*feats, TARGET_COL, "weight").collect())
        weights = {(r[-2], round(r[-1], 9)) for r in train.select(TARGET_COL, "weight").collect()}
        return models.FittedModel(name, feats, train), weights

    weights = {}

    def logistic(train, test, feats, target, weight):
        fitted, weights["logistic_regression"] = fit("logistic_regression", train, feats)
        return fitted

    def trees(name, train, test, feats, target, weight):
        fitted, weights[name] = fit(name, train, feats)
        return fitted

    monkeypatch.setattr(models, "fit_logistic", logistic)
    monkeypatch.setattr(models, "fit_boosted_trees", trees)
    train, _ = Q._train_test(spark, sf_small)
    prep = Q.prepared(spark, sf_small)
    n = {r[TARGET_COL]: r["count"] for r in train.groupBy(TARGET_COL).count().collect()}
    rows = n[0] + n[1]
    for name, feats in (("logistic_regression", prep.features_v1), ("gbt_v1", prep.features_v1), ("gbt_v2", prep.features_v2)):
        Q.fitted(spark, sf_small, name)
        assert len(seen[name]) == rows > 500
        assert seen[name] == sorted(tuple(r) for r in train.select(*feats, TARGET_COL).collect())
    assert weights["logistic_regression"] == {(0, round(rows / (2 * n[0]), 9)), (1, round(rows / (2 * n[1]), 9))}
    assert weights["gbt_v1"] == weights["gbt_v2"] == {(0, 1.0), (1, round(n[0] / n[1], 9))}


def test_tasks_of_a_fit_do_not_grow_with_the_table():
    assert [Q.train_partitions(n, 8) for n in (0, 1, 50_000, 50_001, 480_000, 2_000_001, 28_800_000)] == [1, 1, 1, 2, 8, 9, 116]
