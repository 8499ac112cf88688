"""Newton fit against a plain solver, and trees that learn where missing values go."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import models, newton


def _frame(spark, x, y, w):
    rows = [(str(i), int(b), float(c), *map(float, a)) for i, (a, b, c) in enumerate(zip(x, y, w))]
    names = [f"x{j}" for j in range(x.shape[1])]
    return spark.createDataFrame(rows, "obs_key string, y int, weight double, " + ", ".join(f"{n} double" for n in names)).repartition(5), names


def _by_gradient_equations(x, y, w, c):
    """The optimum by plain Newton on the raw columns in one process."""
    a = np.c_[x, np.ones(len(x))]
    beta, ridge = np.zeros(a.shape[1]), np.r_[np.ones(x.shape[1]), 0.0]
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ beta))
        g = ridge * beta + c * a.T @ (w * (p - y))
        beta = beta - np.linalg.solve(np.diag(ridge) + c * (a * (w * p * (1 - p))[:, None]).T @ a, g)
    return beta


def test_same_optimum_as_plain_solver(spark):
    rng = np.random.default_rng(4)
    x = np.c_[rng.normal(size=(400, 3)), rng.normal(50, 20, 400), rng.integers(0, 2, 400)]
    y = rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] - 0.5 * x[:, 1] + 0.03 * (x[:, 3] - 50) + x[:, 4] - 1)))
    w = np.where(y, 1.7, 0.6)
    df, names = _frame(spark, x, y, w)
    for c in (1.0, 0.01):
        got = newton.fit(df, names, "y", "weight", c=c)
        want = _by_gradient_equations(x, y, w, c)
        assert np.allclose([*got.coefficients, got.intercept], want, rtol=1e-5, atol=1e-7)
        assert got.passes < 15
        assert got.path[-1] <= min(got.path) * (1 + 1e-9)


def test_gram_matrix_order(spark):
    x = np.array([[1.0, 2.0, 3.0], [0.5, -1.0, 4.0]])
    packed = []
    for j in range(3):
        packed += [x[:, j].sum()] + [(x[:, i] * x[:, j]).sum() for i in range(j + 1)]
    full = np.c_[x, np.ones(2)]
    assert np.allclose(newton._square(np.array(packed), 2.0, 3), full.T @ full)


def test_equal_constant_and_huge_columns(spark):
    rng = np.random.default_rng(8)
    a = rng.normal(size=200)
    x = np.c_[a, a, np.full(200, 7.0), a * 1e9 + rng.normal(size=200) * 1e9]
    y = rng.random(200) < 1 / (1 + np.exp(-a))
    df, names = _frame(spark, x, y, np.ones(200))
    got = newton.fit(df, names, "y", "weight")
    assert got.passes < 15 and np.isfinite(got.coefficients).all()
    assert got.coefficients[0] == pytest.approx(got.coefficients[1], rel=1e-4)
    assert got.coefficients[2] == pytest.approx(0.0, abs=1e-12)


def test_separable_one_class_and_empty(spark):
    x = np.arange(-20.0, 20.0)[:, None] + 0.5
    df, names = _frame(spark, x, x[:, 0] > 0, np.ones(40))
    got = newton.fit(df, names, "y", "weight")
    assert got.coefficients[0] > 0 and got.passes < 25
    one = newton.fit(df.withColumn("y", F.lit(1)), names, "y", "weight", max_iter=12)
    assert np.isfinite(one.coefficients).all() and one.intercept > 0
    none = newton.fit(df.filter("false"), names, "y", "weight")
    assert none.coefficients == [0.0] and none.passes == 0
    with pytest.raises(ValueError):
        newton.fit(df, [], "y", "weight")


@pytest.mark.parametrize("like", ["high", "low"])
def test_trees_learn_the_side_of_missing_values(spark, like):
    """Missing rows behave like the high (or low) ones: one split tells all, on whichever side they stand."""
    rng = np.random.default_rng(2)
    x = rng.random(600)
    gone = rng.random(600) < 0.3
    y = np.where(gone, like == "high", x > 0.5)
    rows = [(str(i), int(b), 1.0, None if m else float(a), float(a > 2)) for i, (a, b, m) in enumerate(zip(x, y, gone))]
    df = spark.createDataFrame(rows, "obs_key string, y int, weight double, x double, still double")
    fitted = models.fit_boosted_trees("t", df, df, ["still", "x"], "y", "weight", n_estimators=1, max_depth=1)
    assert fitted.predictions.filter("label <> prediction").count() <= 6
    imp = dict(fitted.importances)
    assert sum(imp.values()) == pytest.approx(1.0) and imp["x"] == pytest.approx(1.0)
    # A value below all others cannot tell them in one split when they are like the high ones.
    filled = df.withColumn("x", F.coalesce("x", F.lit(models.MISSING)))
    wrong = models.fit_boosted_trees("t", filled, filled, ["still", "x"], "y", "weight", n_estimators=1, max_depth=1).predictions.filter("label <> prediction").count()
    assert wrong > 100 if like == "high" else wrong <= 6


def test_saved_linear_model_has_its_weights(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(100, 2))
    df, names = _frame(spark, x, x[:, 0] + rng.normal(size=100) > 0, np.ones(100))
    fitted = models.fit_logistic(df, df, names, "y", "weight")
    back = models.save(spark, fitted, str(tmp_path / "m"))
    stored = {r["feature"]: r["weight"] for r in spark.read.parquet(str(tmp_path / "m" / "model")).collect()}
    assert stored == {**dict(zip(names, fitted.model.coefficients)), None: fitted.model.intercept}
    assert back.predictions.count() == 100 and models.load(spark, "logistic_regression", str(tmp_path / "m")).features == names
