"""Flat observation source built from the driver's relational tables.

The analytics layer consumes one wide observation table (one row per game x
platform x date).  The test data arrives as line items with part, supplier,
nation and region tables; this module recasts them into that shape:

    lineitem -> observation, part -> game, supplier nation -> platform,
    ship date -> observation date, first ship date of a part -> release date.

Everything is a lazy DataFrame plan; :mod:`tessera.sources.stage` writes it once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.categorical import launch_phase
from tessera.functions.numeric import growth_rate, round_half_up
from tessera.operators.joins import MAX_BROADCAST_ROWS, broadcast_if_small
from tessera.session import work_dir

# Fixed values of the recast.
AAA_BRANDS = ["Brand#1", "Brand#2", "Brand#3"]
GENRE_CODES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]  # code = position, others 5

# Total order of a game's observations: date first, then every line column.
# (l_orderkey, l_linenumber) alone is not unique in the test data.
LINE_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]

# Lines of a game above which they are dealt by date too: what one task sorts of a game.
HOT_GAME_ROWS = 200_000
# Hash buckets for each HOT_GAME_ROWS lines: only lines of buckets that exceed it are counted by game.
BUCKETS_PER_HOT = 16

FLAT_COLS = [
    "obs_key",
    "game_id",
    "platform_code",
    "obs_date",
    # game attributes
    "game_name",
    "publisher",
    "publisher_tier",
    "genre",
    "genre_code",
    "release_date",
    "release_year",
    "release_month",
    "release_quarter",
    "base_price_usd",
    "is_indie",
    "is_multiplayer",
    "publisher_avg_budget",
    "is_aaa",
    # platform attributes
    "platform",
    "storefront",
    "subscription_service",
    # calendar attributes
    "obs_year",
    "obs_month",
    "obs_quarter",
    "obs_dow",
    "is_q4",
    "is_summer",
    "is_weekend_obs",
    # measures
    "days_since_release",
    "launch_phase",
    "current_price_usd",
    "discount_pct",
    "concurrent_players",
    "player_growth_rate",
    "steam_rating_pct",
    "twitch_viewers_proxy",
    "hype_score",
    "estimated_revenue_usd",
    "target_revenue_next_4w",
    "target_breakout_hit",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def observation_key(cols: dict) -> F.Column:
    """Stable identity of an observation: md5 over every line column as text.

    Doubles are scaled to integers first so the text form is engine-independent.
    """
    parts = [
        cols["l_orderkey"].cast("string"),
        cols["l_linenumber"].cast("string"),
        cols["l_partkey"].cast("string"),
        cols["l_suppkey"].cast("string"),
        cols["l_quantity"].cast("bigint").cast("string"),
        F.round(cols["l_extendedprice"] * 100).cast("bigint").cast("string"),
        F.round(cols["l_discount"] * 100).cast("bigint").cast("string"),
        F.round(cols["l_tax"] * 100).cast("bigint").cast("string"),
        cols["l_returnflag"],
        cols["l_linestatus"],
        cols["obs_date"].cast("string"),
    ]
    return F.md5(F.concat_ws("|", *parts))


def _hot_games(lines: DataFrame) -> DataFrame:
    """(hot_key, release_date) of the games of more than :data:`HOT_GAME_ROWS` lines, kept in the shared folder.

    Counted by hash bucket first, so that what is shuffled does not grow with the games: a hot
    game makes its bucket exceed the bound, and only the lines of such buckets are counted by game.
    """
    work_dir(lines.sparkSession)  # registers the checkpoint folder
    buckets = BUCKETS_PER_HOT * (1 + lines.count() // HOT_GAME_ROWS)
    rows = lines.select("l_partkey", "obs_date", F.pmod(F.xxhash64("l_partkey"), F.lit(buckets)).alias("bucket"))
    full = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_GAME_ROWS).select("bucket").checkpoint(eager=True)
    # At most one bucket for each HOT_GAME_ROWS lines.
    counted = rows.join(F.broadcast(full), "bucket", "left_semi").groupBy(F.col("l_partkey").alias("hot_key"))
    hot = counted.agg(F.min("obs_date").alias("release_date"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_GAME_ROWS)
    return hot.select("hot_key", "release_date").checkpoint(eager=True)


def _games(part: DataFrame) -> DataFrame:
    """One row per part row: game attributes; ``copy`` numbers the rows of one key from 1."""
    attrs = [c for c in ("p_name", "p_brand", "p_type", "p_size", "p_retailprice") if c in part.columns]
    copy = F.row_number().over(Window.partitionBy("p_partkey").orderBy(*attrs))
    part = part.filter("p_partkey is not null").withColumn("copy", copy)
    aaa = F.col("p_brand").isin(AAA_BRANDS)
    genre_code = F.coalesce(
        F.array_position(F.array(*[F.lit(g) for g in GENRE_CODES]), F.col("p_type")).cast("int") - 1,
        F.lit(5),
    )
    genre_code = F.when(genre_code < 0, F.lit(5)).otherwise(genre_code)
    return part.select(
        F.col("p_partkey").alias("game_id"),
        "copy",
        F.col("p_name").alias("game_name"),
        F.col("p_brand").alias("publisher"),
        F.when(aaa, F.lit("AAA")).when(F.col("p_size") < 10, F.lit("Indie")).otherwise(F.lit("AA")).alias("publisher_tier"),
        F.col("p_type").alias("genre"),
        genre_code.alias("genre_code"),
        F.col("p_retailprice").alias("base_price_usd"),
        (F.col("p_size") < 10).cast("int").alias("is_indie"),
        (F.col("p_size") % 2).cast("int").alias("is_multiplayer"),
        (F.col("p_retailprice") * 1000).alias("publisher_avg_budget"),
        aaa.cast("int").alias("is_aaa"),
        (F.col("p_size") / 50).alias("steam_rating_pct"),
    )


def _platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier -> platform attributes (nation name, region name, subscription)."""
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = broadcast_if_small(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = broadcast_if_small(read_table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    sub_mod = F.col("s_nationkey") % 3
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "inner")
        .join(region, F.col("n_regionkey") == region.r_regionkey, "inner")
        .select(
            F.col("s_suppkey"),
            F.col("s_nationkey").alias("platform_code"),
            F.col("n_name").alias("platform"),
            F.col("r_name").alias("storefront"),
            F.when(sub_mod == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("SUB_"), sub_mod.cast("string")))
            .alias("subscription_service"),
        )
    )


def _with_growth(rows: DataFrame, partitioned: bool = False) -> DataFrame:
    """player_growth_rate = change of concurrent_players vs the game's previous observation.

    A plain ``lag`` over ``partitionBy(game_id)`` would put a hot game (one key may
    hold a large share of all rows) into a single task.  Instead:

    1. rows are hash-partitioned by (game_id, obs_date); one window pass per
       (game, date) cell gives the in-cell predecessor, the row's position and the
       cell's last value;
    2. the first row of every cell carries that last value; a lag over those
       per-cell rows (at most one per calendar day per game) gives each cell's
       predecessor value;
    3. the first row of a cell takes that predecessor.
    The repartition exchange is shared by both uses, so the input is shuffled once.
    ``partitioned=True`` means the rows already arrive hash-partitioned by
    (game_id, obs_date) and no further exchange is added.
    """
    cell = ["game_id", "obs_date"]
    w_cell = Window.partitionBy(*cell).orderBy(*LINE_ORDER)
    w_all = w_cell.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spread = (
        (rows if partitioned else rows.repartition(*cell))
        .withColumn("_prev_in_cell", F.lag("concurrent_players").over(w_cell))
        .withColumn("_pos", F.row_number().over(w_cell))
        .withColumn("_cell_last", F.last("concurrent_players").over(w_all))
    )
    w_game = Window.partitionBy("game_id").orderBy("obs_date")
    cell_prev = spread.filter(F.col("_pos") == 1).select(F.col("game_id").alias("_game"), F.col("obs_date").alias("_date"),
                                                         F.lag("_cell_last").over(w_game).alias("_prev_cell"))
    # Null-safe: rows without a date or a game are cells of their own.
    same = F.col("game_id").eqNullSafe(F.col("_game")) & F.col("obs_date").eqNullSafe(F.col("_date"))
    joined = spread.join(cell_prev, same, "inner").drop("_game", "_date")
    prev = F.when(F.col("_pos") == 1, F.col("_prev_cell")).otherwise(F.col("_prev_in_cell"))
    return joined.withColumn("player_growth_rate", growth_rate(F.col("concurrent_players"), prev)).drop(
        "_prev_in_cell", "_pos", "_prev_cell", "_cell_last"
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat observation table (lazy plan) from the driver tables in ``sf_dir``.

    What is shuffled and sorted are the narrow line rows, once, by game: a game's first date, the
    window of the growth rate and the join with the game attributes, which makes the rows wide, all
    use that partitioning, at any number of games.  A game of more than :data:`HOT_GAME_ROWS`
    lines would be too much for one task; the lines of such games are dealt by (game, date),
    and the few games themselves are broadcast.
    """
    li = read_table(spark, sf_dir, "lineitem").withColumn("obs_date", F.to_date("l_shipdate"))
    li = li.select("l_partkey", *LINE_ORDER, "obs_date").filter("l_partkey is not null")
    part = read_table(spark, sf_dir, "part")
    part_rows = part.count()
    supplier_rows = read_table(spark, sf_dir, "supplier").count()
    platforms = broadcast_if_small(_platforms(spark, sf_dir), supplier_rows)
    games = _games(part)
    hot = _hot_games(li)
    some_hot = hot.limit(1).count() > 0
    at_hot = F.col("l_partkey") == F.col("hot_key")
    at_platform = F.col("l_suppkey") == F.col("s_suppkey")
    usual = li.join(F.broadcast(hot), at_hot, "left_anti") if some_hot else li

    # A broadcast leaves the partitioning as it is; a shuffle join with the platforms comes before it.
    # A game's first date is that of all its lines, those without a platform included.
    by_game = Window.partitionBy("l_partkey").orderBy("obs_date", *LINE_ORDER)
    released = F.min("obs_date").over(by_game.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    if supplier_rows <= MAX_BROADCAST_ROWS:
        usual = usual.repartition("l_partkey").withColumn("release_date", released).join(platforms, at_platform, "inner")
    else:
        # Lines without a supplier would meet in one task of the join.
        found = usual.filter("l_suppkey is not null").join(platforms, at_platform, "left")
        usual = found.unionByName(usual.filter("l_suppkey is null"), allowMissingColumns=True)
        usual = usual.repartition("l_partkey").withColumn("release_date", released).filter("s_suppkey is not null")
    usual = usual.withColumn("prev", F.lag(_players()).over(by_game))
    usual = _recast(usual.join(broadcast_if_small(games, part_rows), F.col("l_partkey") == F.col("game_id"), "inner"), "prev", "copy")
    # Several rows of one part repeat each line: a repeated line follows itself.
    prev = F.when(F.col("copy") == 1, F.col("prev")).otherwise(F.col("concurrent_players"))
    out = usual.withColumn("player_growth_rate", growth_rate(F.col("concurrent_players"), prev)).select(*FLAT_COLS)
    if not some_hot:
        return out
    dealt = li.join(F.broadcast(hot), at_hot, "left_semi").repartition("l_partkey", "obs_date").join(F.broadcast(hot), at_hot, "inner")
    # As many games as hold HOT_GAME_ROWS lines each.
    hot_games = F.broadcast(games.join(F.broadcast(hot), F.col("game_id") == F.col("hot_key"), "left_semi"))
    dealt = dealt.join(hot_games, F.col("l_partkey") == F.col("game_id"), "inner").join(platforms, at_platform, "inner")
    kept = supplier_rows <= MAX_BROADCAST_ROWS
    return out.unionByName(_with_growth(_recast(dealt), partitioned=kept).select(*FLAT_COLS))


def _players() -> F.Column:
    return F.col("l_quantity").cast("bigint") - 1


def _recast(rows: DataFrame, *carry: str) -> DataFrame:
    """Line rows with their game's and platform's attributes as observations, without the growth rate."""
    players = _players()
    days = F.datediff("obs_date", "release_date")
    not_phased = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    iso_dow = F.weekday("obs_date") + 1  # Monday = 1 ... Sunday = 7
    cols = {c: F.col(c) for c in ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                                  "obs_date"]}
    return rows.select(
        *LINE_ORDER,
        *carry,
        observation_key(cols).alias("obs_key"),
        F.col("l_partkey").alias("game_id"),  # line-side key: keeps the line partitioning
        "platform_code",
        "obs_date",
        "game_name",
        "publisher",
        "publisher_tier",
        "genre",
        "genre_code",
        "release_date",
        F.year("release_date").alias("release_year"),
        F.month("release_date").alias("release_month"),
        F.quarter("release_date").alias("release_quarter"),
        "base_price_usd",
        "is_indie",
        "is_multiplayer",
        "publisher_avg_budget",
        "is_aaa",
        "platform",
        "storefront",
        "subscription_service",
        F.year("obs_date").alias("obs_year"),
        F.month("obs_date").alias("obs_month"),
        F.quarter("obs_date").alias("obs_quarter"),
        iso_dow.alias("obs_dow"),
        (F.quarter("obs_date") == 4).cast("int").alias("is_q4"),
        F.month("obs_date").isin(6, 7, 8).cast("int").alias("is_summer"),
        (iso_dow >= 6).cast("int").alias("is_weekend_obs"),
        days.alias("days_since_release"),
        F.when(not_phased, F.lit(None).cast("string")).otherwise(launch_phase(days)).alias("launch_phase"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("current_price_usd"),
        round_half_up(F.col("l_discount") * F.col("l_quantity") * 20, 1).alias("discount_pct"),
        players.alias("concurrent_players"),
        "steam_rating_pct",
        (F.col("l_extendedprice") / 100).alias("twitch_viewers_proxy"),
        F.col("l_tax").alias("hype_score"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("estimated_revenue_usd"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("target_revenue_next_4w"),
        (
            ((F.col("is_aaa") == 1) & (players >= 2))
            | ((F.col("is_aaa") == 0) & (F.col("l_tax") >= 0.08) & (players >= 40))
        ).cast("int").alias("target_breakout_hit"),
    )
