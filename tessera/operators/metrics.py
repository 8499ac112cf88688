"""Classifier evaluation: per-class report and ROC-AUC, both as distributed aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import ratio, round_half_up
from tessera.operators.ordered import FANOUT, FINAL_ROWS, with_value_buckets
from tessera.schema import TARGET_NAMES

REPORT_DIGITS = 4


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: tp, fp, fn, tn for a binary label/prediction pair."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return df.agg(
        F.sum(((y == 1) & (p == 1)).cast("bigint")).alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("bigint")).alias("fp"),
        F.sum(((y == 1) & (p == 0)).cast("bigint")).alias("fn"),
        F.sum(((y == 0) & (p == 0)).cast("bigint")).alias("tn"),
    ).na.fill(0)


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))


def classification_report(df: DataFrame, label: str, prediction: str,
                          target_names: list[str] | None = None) -> DataFrame:
    """Rows (label, precision, recall, f1_score, support) per class, then accuracy,
    macro avg and weighted avg.  A zero denominator gives 0 (not an error)."""
    names = target_names or TARGET_NAMES
    c = confusion_counts(df, label, prediction)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    p1, r1 = ratio(tp, tp + fp), ratio(tp, tp + fn)
    p0, r0 = ratio(tn, tn + fn), ratio(tn, tn + fp)
    f1_1, f1_0 = _f1(p1, r1), _f1(p0, r0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    rows = [
        (F.lit(names[0]), p0, r0, f1_0, s0),
        (F.lit(names[1]), p1, r1, f1_1, s1),
        (F.lit("accuracy"), F.lit(None).cast("double"), F.lit(None).cast("double"), ratio(tp + tn, n), n),
        (F.lit("macro avg"), (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        (F.lit("weighted avg"), ratio(p0 * s0 + p1 * s1, n), ratio(r0 * s0 + r1 * s1, n),
         ratio(f1_0 * s0 + f1_1 * s1, n), n),
    ]
    structs = [
        F.struct(
            F.lit(i).alias("row_order"),
            lbl.alias("label"),
            round_half_up(pr, REPORT_DIGITS).alias("precision"),
            round_half_up(rc, REPORT_DIGITS).alias("recall"),
            round_half_up(f1, REPORT_DIGITS).alias("f1_score"),
            sup.cast("bigint").alias("support"),
        )
        for i, (lbl, pr, rc, f1, sup) in enumerate(rows)
    ]
    return c.select(F.explode(F.array(*structs)).alias("r")).select("r.*").orderBy("row_order").drop("row_order")


def roc_auc(df: DataFrame, label: str, score: str, levels: int | None = None) -> DataFrame:
    """One row ``roc_auc``: area under the ROC curve, ties counted as one half.

    AUC = sum over positives of (negatives scored lower + half the negatives with
    the same score) / (P * N).  Rows are first collapsed to distinct scores with
    positive/negative counts (a partial aggregate, so repeated scores never pile
    up).  The "negatives scored lower" prefix sum needs the score order: up to
    FINAL_ROWS distinct scores it is one window (a bounded task); above that the
    order is split into FANOUT ** levels quantile buckets, with exclusive prefix
    sums over per-bucket totals (a small broadcast table) plus a running sum inside
    each bucket.  NULL when either class is absent.
    """
    per_score = df.groupBy(F.col(score).alias("_s")).agg(
        F.sum(F.col(label).cast("bigint")).alias("_pos"),
        F.sum((1 - F.col(label).cast("bigint"))).alias("_neg"),
    )
    if levels is None:
        n = per_score.count()
        levels = 0 if n <= FINAL_ROWS else max(1, math.ceil(math.log(n / FINAL_ROWS, FANOUT)))
    if levels == 0:
        w = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)  # <= FINAL_ROWS rows
        ranked = per_score.withColumn("_off", F.lit(0)).withColumn("_below_in", F.coalesce(F.sum("_neg").over(w), F.lit(0)))
    else:
        b = with_value_buckets(per_score, "_s", levels)
        totals = b.groupBy("_bucket").agg(F.sum("_neg").alias("_bneg"))
        w_tot = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        # at most FANOUT ** levels rows: one small task
        offsets = totals.select("_bucket", F.coalesce(F.sum("_bneg").over(w_tot), F.lit(0)).alias("_off"))
        w_in = Window.partitionBy("_bucket").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
        ranked = b.withColumn("_below_in", F.coalesce(F.sum("_neg").over(w_in), F.lit(0)))
        ranked = ranked.join(F.broadcast(offsets), "_bucket", "inner")  # <= FANOUT ** levels rows
    contrib = F.col("_pos").cast("double") * (F.col("_off") + F.col("_below_in") + 0.5 * F.col("_neg"))
    agg = ranked.agg(
        F.sum(contrib).alias("_num"),
        F.sum("_pos").cast("double").alias("_p"),
        F.sum("_neg").cast("double").alias("_n"),
    )
    return agg.select(
        F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_num") / (F.col("_p") * F.col("_n"))).alias("roc_auc")
    )
