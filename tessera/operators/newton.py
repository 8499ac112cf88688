"""L2 logistic regression by Newton's method (iteratively reweighted least squares).

Each pass over the rows is one aggregate: loss, gradient and the weighted Gram matrix, summed
as vectors on the JVM (``PolynomialExpansion`` makes the products of a row, ``Summarizer`` adds
them).  Only these sums, a few hundred numbers for some dozen columns, reach the driver, where
the step is solved.  The number of passes does not grow with the data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

# Columns above which the products of one row are too many for this method (a row's vector has about half their square).
MOST_COLUMNS = 500


@dataclass
class LinearModel:
    """Weights of the raw columns; ``passes`` counts the scans of the scaled training rows."""

    features: list[str]
    coefficients: list[float]
    intercept: float
    passes: int = 0
    objective: float = 0.0
    path: list[float] = field(default_factory=list)  # the objective of every pass

    def margin(self, value) -> Column:
        """Log-odds, where ``value(name)`` gives the column of a feature."""
        terms = [F.lit(w) * value(c) for c, w in zip(self.features, self.coefficients)]
        return _total([F.lit(self.intercept), *terms])


def _total(columns: list[Column]) -> Column:
    """Sum of columns as a balanced tree, so that wide models do not nest deeply."""
    while len(columns) > 1:
        columns = [columns[i] + columns[i + 1] if i + 1 < len(columns) else columns[i] for i in range(0, len(columns), 2)]
    return columns[0]


def sigmoid(margin: Column) -> Column:
    """1 / (1 + e^-margin); e to a large power is infinite, which gives 0."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def _square(packed: np.ndarray, total: float, d: int) -> np.ndarray:
    """The (d+1, d+1) Gram matrix, the intercept last, from the sums of a degree-2 expansion:
    column j holds x_j, then its products with x_0 .. x_j."""
    gram = np.empty((d + 1, d + 1))
    gram[d, d] = total
    for j in range(d):
        block = packed[j * (j + 3) // 2:][:j + 2]
        gram[j, d] = gram[d, j] = block[0]
        gram[j, :j + 1] = gram[:j + 1, j] = block[1:]
    return gram


def fit(rows: DataFrame, features: list[str], target: str, weight: str, *, c: float = 1.0, max_iter: int = 50, tol: float = 1e-10) -> LinearModel:
    """Minimises ``0.5 |w|^2 + c * sum_i weight_i * loss_i`` (the intercept is not penalised).

    ``rows``: finite, non-null double ``features``, a 0/1 ``target`` and a non-negative ``weight``;
    they are read twice, the scaled form is kept in memory or on disk for the passes.  Columns are
    centred and scaled inside, which moves the optimum nowhere: the penalty is scaled back.  A step
    that makes the objective worse is halved.  The fit ends when the next step would gain less than ``tol`` of the
    objective.  No rows, or no weight, give weights of 0.
    """
    d = len(features)
    if not 1 <= d <= MOST_COLUMNS:
        raise ValueError(f"{d} columns; 1 to {MOST_COLUMNS} can be fitted")
    first = rows.agg(F.sum(weight), *[F.avg(f) for f in features], *[F.var_samp(f) for f in features]).first()
    if not first[0]:
        return LinearModel(features, [0.0] * d, 0.0)
    mean, scale = np.array(first[1:d + 1], float), np.sqrt(np.array(first[d + 1:], float))  # one row: no variance
    scale[~(scale > 0)] = 1.0
    scaled = [((F.col(f) - F.lit(float(m))) / F.lit(float(v))).alias(f"_z{i}") for i, (f, m, v) in enumerate(zip(features, mean, scale))]
    narrow = rows.select(F.array(*scaled).alias("_z"), F.col(target).cast("double").alias("_y"), F.col(weight).cast("double").alias("_w"))
    narrow = narrow.withColumn("_x", array_to_vector("_z")).persist(StorageLevel.MEMORY_AND_DISK)
    expand = PolynomialExpansion(degree=2, inputCol="_x", outputCol="_products")
    penalty = np.r_[1.0 / scale**2, 0.0]
    hits = narrow.agg(F.sum(F.col("_w") * F.col("_y")), *[F.sum(F.col("_w") * F.col("_y") * F.col("_z")[i]) for i in range(d)]).first()
    hits = np.r_[np.array(hits[1:], float), float(hits[0])]  # sum of weight * target * row: no part of it changes between passes

    def sums(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(objective, gradient, Hessian) at ``beta``: one job, its code the same for every ``beta``."""
        products = F.zip_with("_z", F.array(*[F.lit(float(b)) for b in beta[:d]]), lambda z, b: z * b)
        at = narrow.withColumn("_m", F.aggregate(products, F.lit(float(beta[d])), lambda t, v: t + v)).withColumn("_p", sigmoid(F.col("_m")))
        loss = F.col("_w") * (F.greatest("_m", F.lit(0.0)) - F.col("_y") * F.col("_m") + F.log1p(F.exp(-F.abs("_m"))))
        # The summary refuses weights that add up to 0, as those of rows told with certainty do.
        at = at.withColumn("_wp", F.greatest(F.col("_w") * F.col("_p"), F.lit(1e-300)))
        at = at.withColumn("_h", F.greatest(F.col("_w") * F.col("_p") * (F.lit(1.0) - F.col("_p")), F.lit(1e-300))).withColumn("_loss", loss)
        row = expand.transform(at).agg(Summarizer.metrics("sum").summary(F.col("_x"), F.col("_wp")).alias("g"),
                                       Summarizer.metrics("sum").summary(F.col("_products"), F.col("_h")).alias("h"),
                                       F.sum("_wp").alias("expected"), F.sum("_h").alias("total"), F.sum("_loss").alias("loss")).first()
        objective = 0.5 * float((penalty * beta**2).sum()) + c * float(row["loss"])
        gradient = penalty * beta + c * (np.r_[row["g"]["sum"].toArray(), float(row["expected"])] - hits)
        return objective, gradient, np.diag(penalty) + c * _square(row["h"]["sum"].toArray(), float(row["total"]), d)

    beta, step, share = np.zeros(d + 1), np.zeros(d + 1), 1.0
    best: float | None = None
    path: list[float] = []
    base = beta
    while len(path) < max_iter:
        objective, gradient, hessian = sums(beta)
        path.append(objective)
        if best is not None and not objective <= best + 1e-12 * abs(best):
            share /= 2
            if share < 1e-6:
                beta = base
                break
            beta = base + share * step
            continue
        best, base, share = objective, beta, 1.0
        # Equal columns make the matrix singular: the least step that solves it.
        step = -np.linalg.lstsq(hessian, gradient, rcond=1e-14)[0]
        if -0.5 * float(gradient @ step) <= tol * max(abs(objective), 1e-300):
            break
        beta = base + step
    narrow.unpersist()
    w = base[:d] / scale
    return LinearModel(features, w.tolist(), float(base[d] - math.fsum(w * mean)), len(path), best or 0.0, path)
