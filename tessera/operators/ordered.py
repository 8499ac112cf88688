"""Order statistics without single-task windows.

Spark's exact ``median``/``percentile`` merge every value of a group into one
buffer, and a ``row_number`` over a global or per-class order runs in as many
tasks as there are groups.  With few groups (six genres, two classes) and a group
that may hold a third of all rows, both funnel most of the data through one
task.  The operators here locate the wanted ranks with counts instead:

* medians: a mergeable quantile sketch brackets the wanted ranks of every group in one
  scan; a second one counts the rows below and keeps the values inside;
* hash ranks: hex prefixes of uniform keys are buckets; rows are counted by bucket, and of the
  bucket that holds a quota's boundary the keys are, which gives the key that the quota ends with.

The big input is only scanned and partially aggregated; what is shuffled and sorted is
one bracket or bucket per group.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.joins import broadcast_if_small
from tessera.session import work_dir


FANOUT = 64               # buckets per narrowing level
FINAL_ROWS = 250_000      # rank directly once every wanted range holds at most this many distinct values
SKETCH_ACCURACY = 10_000  # a quantile sketch's rank error is n / SKETCH_ACCURACY at most
BRACKET_SHARE = 1e-3      # half the share of a group's rows that its bracket should hold: ten times that error
ROWS_PER_HASH_BUCKET = 50_000


def _checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint to the shared folder (small summaries only)."""
    work_dir(df.sparkSession)  # ensures a checkpoint folder is registered
    return df.checkpoint(eager=True)


def _edges(df: DataFrame, keys: list[str], value: str, buckets: int) -> DataFrame:
    """Approximate quantile edges per key (array of ``buckets - 1`` values)."""
    probs = [i / buckets for i in range(1, buckets)]
    return df.groupBy(*keys).agg(F.percentile_approx(value, probs, 10_000).alias("_edges"))


def _bucket_expr(value: str, n_edges: int) -> F.Column:
    """Number of edges strictly below the value, as a balanced decision tree.

    Each row takes log2(n_edges) comparisons against fixed positions of the
    sorted ``_edges`` array; the expression has O(n_edges) nodes, all in
    generated code.  Equal values always get the same bucket.
    """
    def node(lo: int, hi: int) -> F.Column:
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.element_at("_edges", mid + 1) < F.col(value), node(mid + 1, hi)).otherwise(node(lo, mid))

    return node(0, n_edges)


def _bracket(vals: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """Scan one: per group the row count and two values that should enclose its middle ranks.

    The quantile sketch is an aggregate state: built per task, merged, its rank error at most
    n / SKETCH_ACCURACY.
    """
    ends = [max(0.0, 0.5 - share), min(1.0, 0.5 + share)]
    return vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(value, ends, SKETCH_ACCURACY).alias("_ends")).select(
        *keys, "_n", F.element_at("_ends", 1).alias("_lo"), F.element_at("_ends", 2).alias("_hi"))


def _enclosed(vals: DataFrame, keys: list[str], value: str, brackets: DataFrame, n_groups: int) -> DataFrame:
    """Scan two: the distinct values inside each group's bracket with their counts (``_c``), and one row (``_below``) that counts the rows below it."""
    v = F.col(value)
    if keys:
        rows = vals.join(broadcast_if_small(brackets, n_groups), keys)
    else:  # one row of literals: nothing is joined on a constant
        b = brackets.first()
        rows = vals.withColumn("_lo", F.lit(b["_lo"])).withColumn("_hi", F.lit(b["_hi"]))
    below = v < F.col("_lo")
    return rows.filter(v <= F.col("_hi")).groupBy(*keys, below.alias("_below"), F.when(~below, v).alias(value)).agg(F.count(F.lit(1)).alias("_c"))


def _at_ranks(dist: DataFrame, keys: list[str], value: str, wanted: DataFrame, n_states: int) -> DataFrame:
    """``keys + ['_which', value]``: the value at each wanted rank ``_r`` of ``dist`` (distinct values and their counts ``_c``).

    While a wanted rank's range holds more than FINAL_ROWS values it is cut at FANOUT quantiles of
    the values, and the part that holds the rank is kept: values are distinct, so every level
    shrinks it.  Then a window adds up the counts.
    """
    state = wanted.select(*keys, "_which", "_r")
    all_ = [*keys, "_which"]
    left = dist.join(broadcast_if_small(state, n_states), keys) if keys else dist.crossJoin(F.broadcast(state))  # two ranks a group
    while True:
        size = left.groupBy(*all_).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
        if size <= FINAL_ROWS:
            break
        edges = _checkpoint(_edges(left, all_, value, FANOUT))
        cut = left.join(broadcast_if_small(edges, n_states), all_).withColumn("_b", _bucket_expr(value, FANOUT - 1)).drop("_edges")
        counts = cut.groupBy(*all_, "_r", "_b").agg(F.sum("_c").alias("_cnt"))
        w = Window.partitionBy(*all_).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
        hit = counts.filter((F.col("_before") <= F.col("_r")) & (F.col("_r") < F.col("_before") + F.col("_cnt"))).select(*all_, "_b", "_before")
        left = _checkpoint(cut.join(broadcast_if_small(_checkpoint(hit), n_states), [*all_, "_b"]).withColumn("_r", F.col("_r") - F.col("_before")).drop("_b", "_before"))
    upto = Window.partitionBy(*all_).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = left.withColumn("_upto", F.sum("_c").over(upto))
    return placed.filter((F.col("_upto") - F.col("_c") <= F.col("_r")) & (F.col("_r") < F.col("_upto"))).select(*all_, value)


def exact_median(df: DataFrame, group_cols: list[str], value: str, alias: str = "median") -> DataFrame:
    """Exact interpolated median of ``value`` per group (NULLs ignored).

    Equals SQL MEDIAN / ``percentile(value, 0.5)``: with n values sorted, the mean
    of the values at 0-based ranks floor((n-1)/2) and ceil((n-1)/2).

    ``df`` is scanned twice at any size: a mergeable quantile sketch brackets the middle ranks of
    each group, then the rows below are counted and the distinct values inside are kept with
    their counts (about 2 * BRACKET_SHARE of the rows).  Only these are read again.  Should a
    rank lie outside its bracket, which the sketch's error bound rules out, a wider one is taken.
    """
    # A NULL in a group column is a group: its JSON text leaves the column out, so the text
    # tells all groups apart and serves as the key of the joins below.
    gcols = ["_group"] if group_cols else []
    vals = df.filter(F.col(value).isNotNull())
    if group_cols:
        vals = vals.withColumn("_group", F.to_json(F.struct(*group_cols)))
    vals = vals.select(*gcols, value)
    for share in (BRACKET_SHARE, 16 * BRACKET_SHARE, 0.5):
        brackets = _checkpoint(_bracket(vals, gcols, value, min(share, 0.5)))
        n_groups = brackets.count()
        dist = _checkpoint(_enclosed(vals, gcols, value, brackets, n_groups))
        inside = F.when(F.col("_below"), 0).otherwise(F.col("_c"))
        sums = dist.groupBy(*gcols).agg(F.sum(F.when(F.col("_below"), F.col("_c")).otherwise(0)).alias("_b"), F.sum(inside).alias("_in"))
        told = brackets.join(sums, gcols, "left") if gcols else brackets.crossJoin(F.broadcast(sums))  # one row each
        which = F.explode(F.array(F.struct(F.lit("lo").alias("_which"), F.floor((F.col("_n") - 1) / 2).alias("_at")),
                                  F.struct(F.lit("hi").alias("_which"), F.ceil((F.col("_n") - 1) / 2).alias("_at"))))
        wanted = told.filter("_n > 0").select(*gcols, "_b", "_in", which.alias("_w")).select(*gcols, "_w._which", (F.col("_w._at") - F.col("_b")).alias("_r"), "_in")
        wanted = _checkpoint(wanted)
        if not wanted.filter((F.col("_r") < 0) | (F.col("_r") >= F.col("_in")) | F.col("_in").isNull()).limit(1).count():
            break
    picked = _at_ranks(dist.filter(~F.col("_below")).drop("_below"), gcols, value, wanted, 2 * n_groups)
    pair = picked.groupBy(*gcols).agg(
        F.max(F.when(F.col("_which") == "lo", F.col(value))).alias("_lo_v"),
        F.max(F.when(F.col("_which") == "hi", F.col(value))).alias("_hi_v"),
    )
    # Equal middle values are the median themselves: inf - inf would be NaN.
    mid = F.when(F.col("_lo_v") == F.col("_hi_v"), F.col("_lo_v")).otherwise(F.col("_lo_v") + (F.col("_hi_v") - F.col("_lo_v")) * 0.5)
    if not group_cols:
        return pair.select(mid.alias(alias))
    names = F.from_json("_group", df.select(*group_cols).schema)
    return pair.select(*[names[c].alias(c) for c in group_cols], mid.alias(alias))


def with_value_buckets(df: DataFrame, value: str, levels: int = 2, fanout: int = FANOUT) -> DataFrame:
    """Attach ``_bucket``: a quantile bucket id of ``value``, monotone in the value.

    Level one cuts the whole range into ``fanout`` quantile buckets (its
    ``fanout - 1`` edges are a one-row summary, inlined as a literal array);
    every further level cuts each bucket again by its own quantiles (a table of
    at most ``fanout ** level`` rows, broadcast on the bucket id), so
    ``fanout ** levels`` balanced buckets result.  Ties always share a bucket.
    """
    probs = [i / fanout for i in range(1, fanout)]
    top = df.agg(F.percentile_approx(value, probs, 10_000).alias("_e")).first()["_e"] or []
    out = df.withColumn("_edges", F.array(*[F.lit(float(e)) for e in top]).cast("array<double>"))
    out = out.withColumn("_bucket", _bucket_expr(value, len(top)).cast("bigint")).drop("_edges")
    for _ in range(levels - 1):
        edges = _checkpoint(_edges(out, ["_bucket"], value, fanout))
        out = out.join(broadcast_if_small(edges), "_bucket", "inner")
        out = out.withColumn("_bucket", F.col("_bucket") * fanout + _bucket_expr(value, fanout - 1)).drop("_edges")
    return out


def _hex_digits(max_rows: int) -> int:
    """Hex-prefix length: about ROWS_PER_HASH_BUCKET rows per bucket at any number of rows."""
    if max_rows <= ROWS_PER_HASH_BUCKET:
        return 1
    return min(15, max(1, math.ceil(math.log(max_rows / ROWS_PER_HASH_BUCKET, 16))))


def _cuts(df: DataFrame, key: str, strata: list[str], quota: DataFrame) -> tuple[list, StructType]:
    """Rows ``strata + ['_cut', '_take', '_tied']`` and their schema: per stratum the key that its quota ends with, how many
    rows of that very key belong to the quota and how many hold it.  No row for a quota of 0.

    Two narrow scans (keys and strata alone): rows by bucket, then the keys of the boundary
    buckets.  One row per stratum reaches the driver.
    """
    spark = df.sparkSession
    rows = df.select(*strata, F.col(key).alias("_key"))
    bucket = F.substring("_key", 1, _hex_digits(df.count()))
    counts = rows.groupBy(*strata, bucket.alias("_hb")).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*strata).orderBy("_hb")  # a row per bucket
    counts = counts.withColumn("_before", F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    counts = counts.withColumn("_n", F.sum("_cnt").over(Window.partitionBy(*strata)))
    if strata:
        counts = counts.join(broadcast_if_small(quota.select(*strata, "_quota")), strata, "inner")
    else:
        counts = counts.withColumn("_quota", F.lit(int(quota.first()["_quota"])))
    # A quota above the stratum size selects the whole stratum.
    left = F.least(F.col("_quota"), F.col("_n")) - F.col("_before")
    boundary = counts.filter((left > 0) & (left <= F.col("_cnt"))).select(*strata, F.col("_hb").alias("_bhb"), left.alias("_m"))
    found = boundary.collect()
    if strata:
        edge = rows.join(broadcast_if_small(spark.createDataFrame(found, boundary.schema), len(found)), strata, "inner").filter(bucket == F.col("_bhb"))
    else:
        at = found[0] if found else {"_bhb": None, "_m": None}
        edge = rows.filter(bucket == F.lit(at["_bhb"]).cast("string")).withColumn("_m", F.lit(at["_m"]).cast("bigint"))
    held = edge.groupBy(*strata, "_m", "_key").agg(F.count(F.lit(1)).alias("_tied"))
    upto = F.sum("_tied").over(Window.partitionBy(*strata).orderBy("_key").rowsBetween(Window.unboundedPreceding, 0))
    held = held.withColumn("_take", F.col("_m") - upto + F.col("_tied"))
    ends = held.filter((F.col("_take") > 0) & (F.col("_take") <= F.col("_tied"))).select(*strata, F.col("_key").alias("_cut"), "_take", "_tied")
    return ends.collect(), ends.schema


def hash_rank_flag(df: DataFrame, key: str, strata: list[str], quota: DataFrame, flag: str = "selected") -> DataFrame:
    """Flag rows whose rank by ``key`` within their stratum is <= the stratum's quota.

    ``key`` must be a lowercase hex digest (uniform, so prefixes give balanced
    buckets and prefix order is key order).  ``quota`` holds ``strata + ['_quota']``
    (one row when ``strata`` is empty).  All rows of ``df`` come back with a
    boolean ``flag``.  The key that a quota ends with is found beforehand, so whole rows are
    read once and compared with it; only if rows of one key would be parted by the quota are
    those rows numbered, apart from the others.
    """
    ends, schema = _cuts(df, key, list(strata), quota)
    if strata:
        marked = df.join(broadcast_if_small(df.sparkSession.createDataFrame(ends, schema), len(ends)), list(strata), "left")
    else:
        end = ends[0] if ends else {"_cut": None, "_take": None, "_tied": None}
        marked = df.withColumns({c: F.lit(end[c]).cast(schema[c].dataType) for c in ("_cut", "_take", "_tied")})
    cols = [*df.columns, flag]
    chosen = marked.withColumn(flag, F.coalesce(F.col(key) <= F.col("_cut"), F.lit(False)))
    if all(r["_take"] == r["_tied"] for r in ends):
        return chosen.select(*cols)
    parted = F.coalesce((F.col(key) == F.col("_cut")) & (F.col("_take") < F.col("_tied")), F.lit(False))
    nth = F.row_number().over(Window.partitionBy(*strata).orderBy(key))
    return chosen.filter(~parted).select(*cols).unionByName(marked.filter(parted).withColumn(flag, nth <= F.col("_take")).select(*cols))
