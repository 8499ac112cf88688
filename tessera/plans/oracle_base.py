"""SQL text of the observation recast and the star schema, for the DuckDB oracle.

Written independently of the DataFrame code in :mod:`tessera.sources.observations`
and :mod:`tessera.operators.star`; only the definitions (FIXTURES.md part C) are
shared.  Every oracle query is ``WITH <these CTEs> SELECT ...`` over the driver's
pre-registered tables.
"""

from __future__ import annotations

from tessera import schema
from tessera.sources.observations import FLAT_COLS


def have(cols: list[str]) -> list[str]:
    """Contract columns the recast carries (the star tables are built from these)."""
    return [c for c in cols if c in FLAT_COLS]


DIM_GAMES_COLS = have(schema.DIM_GAMES_COLS)
DIM_PLATFORM_COLS = have(schema.DIM_PLATFORM_COLS)
DIM_TIME_COLS = have(schema.DIM_TIME_COLS)
FACT_COLS = have(schema.FACT_COLS)

_LINE_ORDER = ("l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, "
               "l_tax, l_returnflag, l_linestatus")

FLAT_CTES = f"""
li AS (
    SELECT *, CAST(l_shipdate AS DATE) AS obs_date FROM lineitem
),
rel AS (
    SELECT l_partkey AS rel_partkey, MIN(obs_date) AS release_date FROM li GROUP BY l_partkey
),
games AS (
    SELECT
        p.p_partkey AS game_id,
        p.p_name AS game_name,
        p.p_brand AS publisher,
        CASE WHEN p.p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'AAA'
             WHEN p.p_size < 10 THEN 'Indie' ELSE 'AA' END AS publisher_tier,
        p.p_type AS genre,
        CAST(CASE p.p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2
             WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 ELSE 5 END AS INTEGER) AS genre_code,
        r.release_date,
        CAST(year(r.release_date) AS INTEGER) AS release_year,
        CAST(month(r.release_date) AS INTEGER) AS release_month,
        CAST(quarter(r.release_date) AS INTEGER) AS release_quarter,
        p.p_retailprice AS base_price_usd,
        CAST(p.p_size < 10 AS INTEGER) AS is_indie,
        CAST(p.p_size % 2 AS INTEGER) AS is_multiplayer,
        p.p_retailprice * 1000 AS publisher_avg_budget,
        CAST(p.p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AS INTEGER) AS is_aaa,
        CAST(p.p_size AS DOUBLE) / 50 AS steam_rating_pct
    FROM part p JOIN rel r ON p.p_partkey = r.rel_partkey
),
plats AS (
    SELECT
        s.s_suppkey,
        s.s_nationkey AS platform_code,
        n.n_name AS platform,
        g.r_name AS storefront,
        CASE WHEN s.s_nationkey % 3 = 0 THEN NULL
             ELSE 'SUB_' || CAST(s.s_nationkey % 3 AS VARCHAR) END AS subscription_service
    FROM supplier s
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region g ON n.n_regionkey = g.r_regionkey
),
base AS (
    SELECT
        li.*, g.*, pl.platform_code, pl.platform, pl.storefront, pl.subscription_service,
        CAST(li.l_quantity AS BIGINT) - 1 AS players,
        CAST(date_diff('day', g.release_date, li.obs_date) AS INTEGER) AS days
    FROM li
    JOIN games g ON li.l_partkey = g.game_id
    JOIN plats pl ON li.l_suppkey = pl.s_suppkey
),
lagged AS (
    SELECT *, LAG(players) OVER (PARTITION BY game_id ORDER BY obs_date, {_LINE_ORDER}) AS prev_players
    FROM base
),
flat AS (
    SELECT
        md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
            CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
            CAST(CAST(l_quantity AS BIGINT) AS VARCHAR),
            CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR),
            CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR),
            CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR),
            l_returnflag, l_linestatus, CAST(obs_date AS VARCHAR))) AS obs_key,
        game_id, platform_code, obs_date,
        game_name, publisher, publisher_tier, genre, genre_code, release_date, release_year,
        release_month, release_quarter, base_price_usd, is_indie, is_multiplayer,
        publisher_avg_budget, is_aaa,
        platform, storefront, subscription_service,
        CAST(year(obs_date) AS INTEGER) AS obs_year,
        CAST(month(obs_date) AS INTEGER) AS obs_month,
        CAST(quarter(obs_date) AS INTEGER) AS obs_quarter,
        CAST(isodow(obs_date) AS INTEGER) AS obs_dow,
        CAST(quarter(obs_date) = 4 AS INTEGER) AS is_q4,
        CAST(month(obs_date) IN (6, 7, 8) AS INTEGER) AS is_summer,
        CAST(isodow(obs_date) >= 6 AS INTEGER) AS is_weekend_obs,
        days AS days_since_release,
        CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL
             WHEN days < 7 THEN 'launch_week'
             WHEN days < 28 THEN 'launch_month'
             WHEN days < 91 THEN 'launch_quarter'
             WHEN days < 365 THEN 'first_year'
             WHEN days < 730 THEN 'second_year'
             ELSE 'long_tail' END AS launch_phase,
        l_extendedprice / l_quantity AS current_price_usd,
        CAST(round(CAST(l_discount * l_quantity * 20 AS DECIMAL(38, 6)), 1) AS DOUBLE) AS discount_pct,
        players AS concurrent_players,
        CASE WHEN prev_players IS NULL THEN NULL
             WHEN prev_players = 0 THEN
                CASE WHEN players > 0 THEN CAST('inf' AS DOUBLE)
                     WHEN players < 0 THEN CAST('-inf' AS DOUBLE)
                     ELSE CAST('nan' AS DOUBLE) END
             ELSE CAST(players - prev_players AS DOUBLE) / CAST(prev_players AS DOUBLE) END
            AS player_growth_rate,
        steam_rating_pct,
        l_extendedprice / 100 AS twitch_viewers_proxy,
        l_tax AS hype_score,
        l_extendedprice * (1 - l_discount) AS estimated_revenue_usd,
        l_extendedprice * (1 + l_tax) AS target_revenue_next_4w,
        CAST((is_aaa = 1 AND players >= 2) OR (is_aaa = 0 AND l_tax >= 0.08 AND players >= 40) AS INTEGER)
            AS target_breakout_hit
    FROM lagged
)"""


def _dim(name: str, key: str, cols: list[str]) -> str:
    attrs = ",\n        ".join(f"any_value({c}) AS {c}" for c in cols if c != key)
    return f"""{name} AS (
    SELECT {key},
        {attrs}
    FROM flat GROUP BY {key}
)"""


STAR_CTES = ",\n".join(
    [
        _dim("dim_games", "game_id", DIM_GAMES_COLS),
        _dim("dim_platform", "platform_code", DIM_PLATFORM_COLS),
        _dim("dim_time", "obs_date", DIM_TIME_COLS),
        f"fact_weekly_metrics AS (\n    SELECT {', '.join(FACT_COLS)} FROM flat\n)",
    ]
)


def with_star(select_sql: str) -> str:
    """Full oracle statement: recast + star CTEs, then ``select_sql``."""
    return f"WITH {FLAT_CTES},\n{STAR_CTES}\n{select_sql}"
