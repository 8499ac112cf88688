"""Seeded, exact-size sampling and stratified splitting.

Rows are ordered by ``md5(seed | salt | obs_key)``: a uniform, engine-independent
hash of a stable row identity.  "The n rows with the smallest hash" is an exact,
repeatable sample of size n; within each class, its quota of smallest hashes is
an exact stratified split.  Both are computed with
:func:`tessera.operators.ordered.hash_rank_flag`, which finds the key that each quota ends
with and compares the rows with it.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ordered import hash_rank_flag
from tessera.schema import RANDOM_STATE, TEST_SIZE


def seeded_key(key_col: str, seed: int, salt: str) -> F.Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(salt), F.col(key_col).cast("string")))


def exact_sample(df: DataFrame, n: int, seed: int = RANDOM_STATE, key_col: str = "obs_key",
                 strict: bool = False) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, chosen by seeded hash order (no replacement).

    ``strict=True`` raises when ``n`` exceeds the row count instead of returning
    every row.
    """
    spark = df.sparkSession
    if strict:
        total = df.count()
        if n > total:
            raise ValueError(f"cannot take a sample of {n} rows from {total} without replacement")
    keyed = df.withColumn("_sample_key", seeded_key(key_col, seed, "sample"))
    quota = spark.createDataFrame([(int(n),)], "_quota bigint")
    flagged = hash_rank_flag(keyed, "_sample_key", [], quota, flag="_in_sample")
    return flagged.filter("_in_sample").drop("_in_sample", "_sample_key")


def stratified_split(df: DataFrame, target: str, test_size: float = TEST_SIZE, seed: int = RANDOM_STATE,
                     key_col: str = "obs_key") -> DataFrame:
    """Add ``split``: 'test' for ceil(test_size * n) rows in all, else 'train'.

    The total goes to the classes by largest remainder (equal ones by the class's text).
    A NULL class is an error.
    """
    keyed = df.withColumn("_split_key", seeded_key(key_col, seed, "split"))
    sizes = {r[target]: r["n"] for r in df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per class
    if None in sizes:
        raise ValueError(f"{target} is NULL in {sizes[None]} rows")
    share = Fraction(str(test_size))
    quotas = {c: share * n // 1 for c, n in sizes.items()}
    left = math.ceil(share * sum(sizes.values())) - sum(quotas.values())
    for c in sorted(sizes, key=lambda c: (-(share * sizes[c] % 1), str(c)))[:left]:
        quotas[c] += 1
    schema = T.StructType([T.StructField(target, df.schema[target].dataType), T.StructField("_quota", T.LongType())])
    quota = df.sparkSession.createDataFrame([(c, int(q)) for c, q in quotas.items()], schema)
    flagged = hash_rank_flag(keyed, "_split_key", [target], quota, flag="_is_test")
    return flagged.withColumn("split", F.when(F.col("_is_test"), F.lit("test")).otherwise(F.lit("train"))).drop(
        "_is_test", "_split_key"
    )


def split_balance(split_df: DataFrame, target: str) -> DataFrame:
    """Rows per (split, class) and the class share within each split."""
    counts = split_df.groupBy("split", target).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
    return counts.orderBy("split", target)
