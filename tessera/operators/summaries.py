"""Mergeable summaries that are written with a table, so that checks need not read its rows.

A column profile holds counts of rows, NULLs and non-finite values.  A key state holds, for
each key and column, the least and the greatest value (two witnesses that differ if the column
is not constant for the key).  A presence table holds, for each group, bitmaps of the keys seen
in it, from which exact distinct counts of any coarser grouping follow.  Summaries of two
parts of a table merge into those of the whole by sums, least and greatest values and bit-or.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.numeric import NEG_INF, POS_INF

PROFILE_COUNTS = ["n_rows", "n_null", "n_nan", "n_pos_inf", "n_neg_inf"]

#: Keys that one bitmap covers (the width of Spark's bitmap functions).
BITMAP_BITS = 32_768


# ---------------------------------------------------------------------------
# Column profiles
# ---------------------------------------------------------------------------

def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_null, n_nan, n_pos_inf, n_neg_inf) per column, in one aggregate.

    Columns that are no floating numbers have 0 non-finite values; an empty table has 0 everywhere.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    made = []
    for i, f in enumerate(df.schema.fields):
        x = F.col(f"`{f.name}`")
        aggs.append(F.count(x).alias(f"_seen{i}"))
        counts = [F.col("_rows").alias("n_rows"), (F.col("_rows") - F.col(f"_seen{i}")).alias("n_null")]
        floating = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        for name, found in (("n_nan", F.isnan(x)), ("n_pos_inf", x == F.lit(POS_INF)), ("n_neg_inf", x == F.lit(NEG_INF))) if floating else ():
            aggs.append(F.count_if(found).alias(f"_{name}{i}"))
        counts += [(F.col(f"_{name}{i}") if floating else F.lit(0).cast("bigint")).alias(name) for name in PROFILE_COUNTS[2:]]
        made.append(F.struct(F.lit(f.name).alias("column_name"), *counts))
    return df.agg(*aggs).select(F.explode(F.array(*made)).alias("p")).select("p.*")


def merge_profiles(profiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Profiles of parts (stacked) as profiles of the whole."""
    return profiles.groupBy(*(by or []), "column_name").agg(*[F.sum(c).alias(c) for c in PROFILE_COUNTS])


def null_counts(profile: DataFrame, columns: list[str] | None = None, only_positive: bool = True) -> DataFrame:
    """(column_name, null_count) of a profile; NaN counts as missing, as ``checks.null_counts`` has it."""
    if columns is not None:
        profile = profile.filter(F.col("column_name").isin(columns))
    out = profile.select("column_name", (F.col("n_null") + F.col("n_nan")).alias("null_count"))
    return out.filter(F.col("null_count") > 0) if only_positive else out


def nonfinite_audit(profile: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_pos_inf, n_neg_inf, n_nan, n_null) of the given columns of a profile."""
    return profile.filter(F.col("column_name").isin(columns)).select("column_name", "n_pos_inf", "n_neg_inf", "n_nan", "n_null")


def row_counts(profiles: DataFrame) -> DataFrame:
    """(table_name, row_count) of profiles that carry a ``table_name``."""
    return profiles.groupBy("table_name").agg(F.max("n_rows").alias("row_count"))


# ---------------------------------------------------------------------------
# Key states
# ---------------------------------------------------------------------------

def _attributes(df: DataFrame, key: str) -> list[str]:
    return [c for c in df.columns if c not in (key, "n_rows")]


def key_states(tuples: DataFrame, key: str) -> DataFrame:
    """One row per key of ``star.key_tuples``: ``n_rows``, and for each other column a struct
    (lo, hi) of its least and greatest non-NULL value, both NULL if it has none."""
    attrs = _attributes(tuples, key)
    ends = tuples.groupBy(key).agg(F.sum("n_rows").alias("n_rows"), *[e for c in attrs for e in (F.min(c).alias(f"{c} lo"), F.max(c).alias(f"{c} hi"))])
    return ends.select(key, "n_rows", *[F.struct(F.col(f"`{c} lo`").alias("lo"), F.col(f"`{c} hi`").alias("hi")).alias(c) for c in attrs])


def merge_key_states(states: DataFrame, key: str) -> DataFrame:
    """States of parts (stacked) as states of the whole."""
    attrs = _attributes(states, key)
    ends = states.groupBy(key).agg(F.sum("n_rows").alias("n_rows"), *[e for c in attrs for e in (F.min(f"{c}.lo").alias(f"{c} lo"), F.max(f"{c}.hi").alias(f"{c} hi"))])
    return ends.select(key, "n_rows", *[F.struct(F.col(f"`{c} lo`").alias("lo"), F.col(f"`{c} hi`").alias("hi")).alias(c) for c in attrs])


def _differ(c: str) -> F.Column:
    return F.coalesce(F.col(f"{c}.lo") != F.col(f"{c}.hi"), F.lit(False))


def conflict_counts(states: DataFrame, table: str, key: str) -> DataFrame:
    """(table_name, column_name, conflicting_keys): keys with more than one value, per column."""
    attrs = _attributes(states, key)
    wide = states.agg(*[F.count_if(_differ(c)).alias(c) for c in attrs])
    return wide.unpivot([], attrs, "column_name", "conflicting_keys").select(F.lit(table).alias("table_name"), "column_name", "conflicting_keys")


def conflicts(states: DataFrame, tuples: DataFrame, table: str, key: str) -> DataFrame:
    """The keys and columns that hold more than one value, with the two witnesses and their rows.

    (table_name, column_name, key_value, n_values, low, n_low, high, n_high): ``n_values``
    distinct non-NULL values, least and greatest with the rows that hold them; values as text.
    Only tuples of conflicting keys are shuffled to be counted; a NULL key is a key.
    """
    attrs = _attributes(states, key)
    found = F.array_compact(F.array(*[
        F.when(_differ(c), F.struct(F.lit(c).alias("column_name"), F.col(f"{c}.lo").cast("string").alias("low"), F.col(f"{c}.hi").cast("string").alias("high")))
        for c in attrs]))
    named = states.select(F.col(key).alias("_key"), F.explode(found).alias("c")).select("_key", "c.*")
    keys = named.select("_key").distinct()
    texts = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in attrs])
    held = tuples.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi").select(F.col(key).alias("k"), "n_rows", F.explode(texts).alias("v"))
    values = held.filter("v.value is not null").groupBy("k", F.col("v.column_name").alias("column"), F.col("v.value").alias("value")).agg(F.sum("n_rows").alias("n"))
    both = values.join(named, F.col("k").eqNullSafe(F.col("_key")) & (F.col("column") == F.col("column_name")))
    out = both.groupBy("column_name", F.col("k").cast("string").alias("key_value"), "low", "high").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.max(F.when(F.col("value") == F.col("low"), F.col("n"))).alias("n_low"),
        F.max(F.when(F.col("value") == F.col("high"), F.col("n"))).alias("n_high"))
    return out.select(F.lit(table).alias("table_name"), "column_name", "key_value", "n_values", "low", "n_low", "high", "n_high")


# ---------------------------------------------------------------------------
# Presence bitmaps
# ---------------------------------------------------------------------------

def presence(df: DataFrame, groups: list[str], key: str, hot: DataFrame | None = None) -> DataFrame:
    """(groups..., bucket, bitmap): the integer keys seen in each group, one bit each.

    Rows collapse to distinct (group, key) pairs first, so that a hot group or key costs
    nothing, and then go to the task of their (group, bucket): at most ``BITMAP_BITS`` pairs
    make a bitmap, and none is sent before it is whole.  ``hot``: a few keys (a column of the same
    name) of many rows; only theirs collapse first, the other rows are shuffled once.  NULL keys are in no bitmap (a
    distinct count leaves them out too), a group without any other key has no row; NULL is a
    group.  Keys must be integers: number others first (``numbered_keys``).
    """
    if not isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"{key} is no integer column")
    at = F.col(key).cast("bigint")
    bits = [*groups, F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("_bit")]
    seen = df.filter(F.col(key).isNotNull())
    if hot is None:
        pairs = seen.select(*bits).distinct()
    else:
        many = F.broadcast(hot.select(F.col(key).alias("_hot")))
        is_hot = F.col(key) == F.col("_hot")
        pairs = seen.join(many, is_hot, "left_anti").select(*bits).unionAll(seen.join(many, is_hot, "left_semi").select(*bits).distinct())
    return pairs.repartition(*groups, "bucket").groupBy(*groups, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def numbered_keys(dim: DataFrame, key: str) -> DataFrame:
    """(key, key_number): an integer for each row of a dimension, dense within a partition, for
    keys that are no integers.  Write it once before use: the numbers follow the partitions."""
    return dim.filter(F.col(key).isNotNull()).select(key, (F.monotonically_increasing_id() + 1).alias("key_number"))


def distinct_counts(bitmaps: DataFrame, groups: list[str], name: str) -> DataFrame:
    """(groups..., name): exact distinct keys per group, which may be any of the presence
    table's groups, or none of them for the whole."""
    merged = bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*groups).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("bigint").alias(name))


def merge_presence(bitmaps: DataFrame, groups: list[str]) -> DataFrame:
    """Presence of parts (stacked) as presence of the whole."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
