"""Feature preparation: column dropping, label encoding, feature lists, class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.categorical import as_label_text
from tessera.operators.joins import broadcast_if_small


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns by name; an unknown name is an error (Spark alone would ignore it)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def label_map(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, label, code): codes 0..k-1 in sorted order of the text labels.

    The distinct labels of a categorical column are few; ranking them uses a
    window partitioned by column, i.e. one small task per column.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), as_label_text(c).alias("label"))
                                 for c in cols]))
    # One scan: every row emits (column, label) pairs, collapsed map-side by distinct.
    labels = df.select(pairs.alias("p")).select("p.column_name", "p.label").distinct()
    w = Window.partitionBy("column_name").orderBy("label")
    return labels.withColumn("code", (F.dense_rank().over(w) - 1).cast("int"))


def label_encode(df: DataFrame, cols: list[str], mapping: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Replace each categorical column by its integer code; returns (encoded frame, label map)."""
    mapping = label_map(df, cols) if mapping is None else mapping
    out = df
    for c in cols:
        m = mapping.filter(F.col("column_name") == c).select(F.col("label").alias(f"_lbl_{c}"),
                                                             F.col("code").alias(f"_code_{c}"))
        out = out.withColumn(f"_lbl_{c}", as_label_text(c))
        out = out.join(broadcast_if_small(m), f"_lbl_{c}", "left")
        out = out.withColumn(c, F.col(f"_code_{c}")).drop(f"_lbl_{c}", f"_code_{c}")
    return out.select(*df.columns), mapping


def feature_list(columns: list[str], drop: list[str], target: str, extra_drop: list[str] | None = None) -> list[str]:
    """Model inputs: every column except identifiers, dropped ones and the target."""
    gone = set(drop) | {target} | set(extra_drop or [])
    unknown = sorted(gone - set(columns))
    if unknown:
        raise KeyError(f"columns not found: {unknown}")
    return [c for c in columns if c not in gone]


def feature_columns(spark: SparkSession, sets: dict[str, DataFrame]) -> DataFrame:
    """(feature_set, position, feature): the columns of each feature frame, in order."""
    rows = [(name, i + 1, c) for name, df in sets.items() for i, c in enumerate(df.columns)]
    return spark.createDataFrame(rows, "feature_set string, position int, feature string")


def class_weights(train: DataFrame, target: str) -> DataFrame:
    """One row: class counts, 'balanced' weights n/(2*n_c) and the negative/positive ratio."""
    counts = train.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum((F.col(target) == 0).cast("bigint")).alias("n_negative"),
        F.sum((F.col(target) == 1).cast("bigint")).alias("n_positive"),
    )
    n, n0, n1 = F.col("n_rows").cast("double"), F.col("n_negative").cast("double"), F.col("n_positive").cast("double")
    return counts.select(
        F.col("n_rows").cast("bigint").alias("n_rows"),
        F.col("n_negative").cast("bigint").alias("n_negative"),
        F.col("n_positive").cast("bigint").alias("n_positive"),
        F.when(n0 > 0, n / (2 * n0)).alias("weight_negative"),
        F.when(n1 > 0, n / (2 * n1)).alias("weight_positive"),
        F.when(n1 > 0, n0 / n1).alias("scale_pos_weight"),
    )


def with_weight(df: DataFrame, target: str, weights: dict, kind: str, col: str = "weight") -> DataFrame:
    """Attach a per-row training weight.

    kind='balanced': n/(2*n_c) per class; kind='pos_ratio': negatives/positives for
    positives, 1 for negatives.
    """
    if kind == "balanced":
        w = F.when(F.col(target) == 1, F.lit(weights["weight_positive"])).otherwise(F.lit(weights["weight_negative"]))
    elif kind == "pos_ratio":
        w = F.when(F.col(target) == 1, F.lit(weights["scale_pos_weight"])).otherwise(F.lit(1.0))
    else:
        raise ValueError(f"unknown weighting {kind!r}")
    return df.withColumn(col, w.cast("double"))
