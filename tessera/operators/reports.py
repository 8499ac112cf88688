"""Business reports over the star schema.

Scale notes.  The fact table is huge and the dimensions are small to medium, and
reports group by a handful of keys.  Where the grouping key is a dimension key or
a function of one, the fact is aggregated first (map-side partial aggregation
collapses it to one row per key and task), and only that result meets the
dimension; the row-level fact is never shuffled for those reports.  Averages are
carried as (sum, count) pairs so they can be combined after the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.categorical import discount_bucket, phase_rank
from tessera.functions.numeric import finite_or_null, round_half_up, round_plain
from tessera.operators.joins import MAX_BROADCAST_ROWS, broadcast_if_small
from tessera.operators.ordered import exact_median
from tessera.operators.summaries import distinct_counts
from tessera.session import work_dir


def _sum_count(col: str, name: str | None = None, value: Column | None = None) -> list[Column]:
    name = name or col
    v = F.col(col) if value is None else value
    return [F.sum(v).alias(f"_s_{name}"), F.count(v).alias(f"_n_{name}")]


def _mean(name: str) -> Column:
    """AVG from a (sum, count) pair; NULL when no value was counted."""
    return F.when(F.col(f"_n_{name}") > 0, F.col(f"_s_{name}") / F.col(f"_n_{name}"))


def _resum(name: str) -> list[Column]:
    return [F.sum(f"_s_{name}").alias(f"_s_{name}"), F.sum(f"_n_{name}").alias(f"_n_{name}")]


# ---------------------------------------------------------------------------
# Genre revenue (fact x dim_games)
# ---------------------------------------------------------------------------

def genre_revenue(fact: DataFrame, games: DataFrame, games_rows: int | None = None, top: int | None = 15) -> DataFrame:
    """Per genre: games present, mean/median weekly revenue, mean players; top-k by mean revenue."""
    genres = broadcast_if_small(games.select("game_id", "genre"), games_rows)
    per_game = fact.groupBy("game_id").agg(
        *_sum_count("estimated_revenue_usd", "rev"), *_sum_count("concurrent_players", "players")
    )
    by_genre = per_game.join(genres, "game_id", "inner").groupBy("genre").agg(
        F.count(F.lit(1)).alias("game_count"), *_resum("rev"), *_resum("players")
    )
    rows = fact.select("game_id", "estimated_revenue_usd").join(genres, "game_id", "inner")
    if games_rows is None or games_rows > MAX_BROADCAST_ROWS:
        # Shuffle join: the median scans its input once per narrowing level, so the
        # narrow (genre, revenue) rows are written once to the shared checkpoint
        # folder instead of repeating the join on every pass.
        work_dir(rows.sparkSession)
        rows = rows.checkpoint(eager=True)
    med = exact_median(rows, ["genre"], "estimated_revenue_usd", alias="_median")
    # At most one median row per genre, and genres <= games: a proven bound.
    med = med.withColumnRenamed("genre", "_genre")
    out = by_genre.join(broadcast_if_small(med, games_rows), F.col("genre").eqNullSafe(F.col("_genre")), "left").select(
        "genre",
        F.col("game_count").cast("bigint").alias("game_count"),
        round_half_up(_mean("rev"), 2).alias("avg_weekly_revenue"),
        round_half_up("_median", 2).alias("median_weekly_revenue"),
        round_half_up(_mean("players"), 0).alias("avg_players"),
    )
    out = out.orderBy(F.desc_nulls_last("avg_weekly_revenue"), F.asc("genre"))
    return out.limit(top) if top else out


def genre_chart_series(report: DataFrame) -> DataFrame:
    """Bar-chart series: mean weekly revenue in USD millions per genre."""
    return report.select("genre", (F.col("avg_weekly_revenue") / 1_000_000).alias("avg_weekly_revenue_musd"))


def genre_skew(report: DataFrame) -> DataFrame:
    """Mean vs median revenue per genre; a ratio well above 1 means a right-skewed genre."""
    return report.select(
        "genre",
        "avg_weekly_revenue",
        "median_weekly_revenue",
        round_half_up(F.col("avg_weekly_revenue") / F.col("median_weekly_revenue"), 3).alias("mean_to_median"),
    )


# ---------------------------------------------------------------------------
# Lifecycle (fact only)
# ---------------------------------------------------------------------------

def lifecycle(fact: DataFrame) -> DataFrame:
    """Per lifecycle phase (NULL phase excluded): means of players, revenue, hype, discount; row count."""
    out = (
        fact.filter(F.col("launch_phase").isNotNull())
        .groupBy("launch_phase")
        .agg(
            round_half_up(F.avg("concurrent_players"), 0).alias("avg_players"),
            round_half_up(F.avg("estimated_revenue_usd"), 2).alias("avg_revenue"),
            round_half_up(F.avg("hype_score"), 3).alias("avg_hype"),
            round_half_up(F.avg("discount_pct"), 3).alias("avg_discount"),
            F.count(F.lit(1)).cast("bigint").alias("observation_count"),
        )
    )
    return out.orderBy(F.desc_nulls_last("avg_players"), F.asc("launch_phase"))


def lifecycle_ordered(fact: DataFrame) -> DataFrame:
    """Lifecycle report in chronological phase order; unknown phases sort last."""
    rep = lifecycle(fact).withColumn("phase_order", phase_rank("launch_phase"))
    return rep.orderBy(F.asc_nulls_last("phase_order"), F.asc("launch_phase"))


def lifecycle_chart_series(report: DataFrame) -> DataFrame:
    return report.select(
        "launch_phase",
        "phase_order",
        (F.col("avg_players") / 1_000).alias("avg_players_k"),
        (F.col("avg_revenue") / 1_000_000).alias("avg_revenue_musd"),
    )


# ---------------------------------------------------------------------------
# Platform comparison (fact x dim_platform)
# ---------------------------------------------------------------------------

_PLATFORM_MEASURES = [
    ("concurrent_players", "players", "avg_players", 0),
    ("estimated_revenue_usd", "rev", "avg_revenue", 2),
    ("hype_score", "hype", "avg_hype", 3),
    ("discount_pct", "disc", "avg_discount", 3),
    ("steam_rating_pct", "rating", "avg_rating", 3),
]


def platform_comparison(fact: DataFrame, platform: DataFrame, platform_rows: int | None = None,
                        games_seen: DataFrame | None = None) -> DataFrame:
    """Per platform: means of five measures and the number of distinct games.

    ``games_seen``: a presence table (``summaries.presence``) of the fact's games by at least
    the platform; the games are then counted from its bitmaps and the fact is aggregated by
    platform alone.  Without it they are counted from the fact.
    """
    aggs = []
    for col, short, _, _ in _PLATFORM_MEASURES:
        aggs += _sum_count(col, short)
    if games_seen is None:
        per_code = fact.groupBy("platform_code").agg(*aggs, F.countDistinct("game_id").alias("unique_games"))
    else:
        games = distinct_counts(games_seen, ["platform_code"], "unique_games")
        per_code = fact.groupBy("platform_code").agg(*aggs).join(games, "platform_code", "left").fillna(0, ["unique_games"])
    dim = broadcast_if_small(platform.select("platform_code", "platform"), platform_rows)
    # platform_code is the dimension key, so grouping by (platform, platform_code)
    # after the join equals the per-code aggregate joined 1:1.
    out = per_code.join(dim, "platform_code", "inner").select(
        "platform",
        "platform_code",
        *[round_half_up(_mean(short), digits).alias(name) for _, short, name, digits in _PLATFORM_MEASURES],
        F.col("unique_games").cast("bigint").alias("unique_games"),
    )
    return out.orderBy(F.desc_nulls_last("avg_players"), F.asc("platform_code"))


def platform_report(comparison: DataFrame) -> DataFrame:
    return comparison.select("platform", "avg_players", "avg_revenue", "avg_rating", "avg_discount", "unique_games")


def platform_chart_series(comparison: DataFrame) -> DataFrame:
    return comparison.select(
        "platform",
        (F.col("avg_players") / 1_000).alias("avg_players_k"),
        (F.col("avg_revenue") / 1_000_000).alias("avg_revenue_musd"),
    )


# ---------------------------------------------------------------------------
# Discount effect (fact only)
# ---------------------------------------------------------------------------

def discount_effect(fact: DataFrame, clean: bool = False) -> DataFrame:
    """Per discount bucket: mean players, revenue, player growth; row count; ordered by min discount.

    ``clean=False`` keeps the raw growth average (inf/NaN propagate, plain ROUND);
    ``clean=True`` averages only finite growth values.
    """
    growth = finite_or_null("player_growth_rate") if clean else F.col("player_growth_rate")
    avg_growth = F.avg(growth)
    out = (
        fact.withColumn("discount_bucket", discount_bucket("discount_pct"))
        .groupBy("discount_bucket")
        .agg(
            round_half_up(F.avg("concurrent_players"), 0).alias("avg_players"),
            round_half_up(F.avg("estimated_revenue_usd"), 2).alias("avg_revenue"),
            (round_half_up(avg_growth, 4) if clean else round_plain(avg_growth, 4)).alias("avg_player_growth"),
            F.count(F.lit(1)).cast("bigint").alias("observation_count"),
            F.min("discount_pct").alias("_min_discount"),
        )
    )
    return out.orderBy(F.asc_nulls_last("_min_discount"), F.asc("discount_bucket")).drop("_min_discount")


def discount_bucket_edges(fact: DataFrame) -> DataFrame:
    """Observed discount range per bucket, incl. rows with a NULL discount."""
    out = (
        fact.withColumn("discount_bucket", discount_bucket("discount_pct"))
        .groupBy("discount_bucket")
        .agg(
            F.min("discount_pct").alias("min_discount"),
            F.max("discount_pct").alias("max_discount"),
            F.count(F.lit(1)).cast("bigint").alias("observation_count"),
            F.count("discount_pct").cast("bigint").alias("non_null_count"),
        )
    )
    return out.orderBy(F.asc_nulls_last("min_discount"))


def discount_chart_series(report: DataFrame) -> DataFrame:
    return report.select(
        "discount_bucket",
        (F.col("avg_players") / 1_000).alias("avg_players_k"),
        (F.col("avg_revenue") / 1_000_000).alias("avg_revenue_musd"),
    )


def discount_by_phase(fact: DataFrame) -> DataFrame:
    """Crosstab of discount bucket and lifecycle phase: rows and mean players.

    Shows the confounding of discount depth with game age.
    """
    out = (
        fact.withColumn("discount_bucket", discount_bucket("discount_pct"))
        .groupBy("discount_bucket", "launch_phase")
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("observation_count"),
            round_half_up(F.avg("concurrent_players"), 0).alias("avg_players"),
        )
    )
    return out.orderBy("discount_bucket", F.asc_nulls_last(phase_rank("launch_phase")))


# ---------------------------------------------------------------------------
# Flag / label agreement and calendar rollup
# ---------------------------------------------------------------------------

def flag_label_crosstab(games: DataFrame, flag: str = "is_indie", label: str = "publisher_tier",
                        label_value: str = "Indie") -> DataFrame:
    """Count games by a 0/1 flag vs. whether a text label says the same thing."""
    return (
        games.groupBy(
            F.col(flag).cast("int").alias("flag_value"),
            (F.col(label) == label_value).cast("int").alias("label_matches"),
        )
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_games"))
        .orderBy("flag_value", "label_matches")
    )


def calendar_rollup(fact: DataFrame, time: DataFrame, time_rows: int | None = None) -> DataFrame:
    """Per year and quarter via dim_time: rows, mean revenue, players and discount."""
    per_date = fact.groupBy("obs_date").agg(
        F.count(F.lit(1)).alias("_rows"),
        *_sum_count("estimated_revenue_usd", "rev"),
        *_sum_count("concurrent_players", "players"),
        *_sum_count("discount_pct", "disc"),
    )
    cal = broadcast_if_small(time.select("obs_date", "obs_year", "obs_quarter"), time_rows)
    out = (
        per_date.join(cal, "obs_date", "inner")
        .groupBy("obs_year", "obs_quarter")
        .agg(F.sum("_rows").alias("_rows"), *_resum("rev"), *_resum("players"), *_resum("disc"))
        .select(
            "obs_year",
            "obs_quarter",
            F.col("_rows").cast("bigint").alias("observation_count"),
            round_half_up(_mean("rev"), 2).alias("avg_revenue"),
            round_half_up(_mean("players"), 0).alias("avg_players"),
            round_half_up(_mean("disc"), 3).alias("avg_discount"),
        )
    )
    return out.orderBy("obs_year", "obs_quarter")
