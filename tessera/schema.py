"""Column contract of the star schema and the modelling frame.

The raw source is one flat observation table (one row per game x platform x
date observation).  The star schema splits it column by column into three
dimensions and one fact table; apart from the three foreign keys every raw
column lands in exactly one table.  Column lists below are the published contract;
a source that lacks some of them names those it carries, else building a table raises.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must equal the published behaviour for results to match.
# ---------------------------------------------------------------------------

# Lifecycle phases in chronological order (used for the categorical sort).
PHASE_ORDER = [
    "launch_week",
    "launch_month",
    "launch_quarter",
    "first_year",
    "second_year",
    "long_tail",
]

# Upper bounds (exclusive, days since release) of the first five phases; later is long_tail.
PHASE_DAY_LIMITS = [7, 28, 91, 365, 730]

# Discount buckets: label and half-open range [low, high) on discount_pct.
# '0% (no discount)' is the exact-zero case; everything not caught by the
# first five branches (incl. NULL and negative values) falls to '75%+'.
DISCOUNT_BUCKETS = [
    ("0% (no discount)", None, None),
    ("1-9%", 0, 10),
    ("10-24%", 10, 25),
    ("25-49%", 25, 50),
    ("50-74%", 50, 75),
    ("75%+", None, None),
]

# Minimum row counts per star table used by the verification step.
EXPECTED_MIN_ROWS = {
    "dim_games": 9_000,
    "dim_platform": 6,
    "dim_time": 2_000,
    "fact_weekly_metrics": 5_000_000,
}

# Modelling constants.
SAMPLE_SIZE = 200_000
RANDOM_STATE = 42
TARGET_COL = "target_breakout_hit"
TARGET_NAMES = ["Not Breakout", "Breakout Hit"]
DROP_COLS = ["game_id", "game_name", "publisher", "genre_code", "target_revenue_next_4w"]
CAT_COLS = ["genre", "platform_code", "publisher_tier"]
LEAKY_FEATURE = "is_aaa"
TEST_SIZE = 0.2
GBT_PARAMS = {"n_estimators": 200, "max_depth": 6, "learning_rate": 0.1}
LR_MAX_ITER = 1000

# ---------------------------------------------------------------------------
# Star schema column lists.
# ---------------------------------------------------------------------------

GAME_KEY = "game_id"
PLATFORM_KEY = "platform_code"
TIME_KEY = "obs_date"

# The published column contract of the four star tables, in the
# published order.  A source that lacks some of them names those it carries (the test
# recast does); any other lack is an error.
DIM_GAMES_COLS = [
    "game_id", "game_name", "developer", "publisher", "publisher_tier", "franchise", "genre",
    "genre_code", "subgenre", "tags", "age_rating", "release_date", "release_year", "release_month",
    "release_quarter", "base_price_usd", "dlc_count", "expansion_count", "achievement_count",
    "supported_languages", "is_free_to_play", "is_indie", "is_early_access", "is_multiplayer",
    "is_online", "is_franchise", "is_sequel", "is_remaster", "is_remake", "is_crossplay",
    "has_crossbuy", "publisher_market_share", "publisher_avg_budget", "is_aaa",
    "holiday_release_flag", "q4_release_flag",
]

DIM_PLATFORM_COLS = ["platform_code", "platform", "storefront", "subscription_service"]

DIM_TIME_COLS = [
    "obs_date", "obs_year", "obs_month", "obs_quarter", "obs_dow", "is_q4", "is_summer", "is_weekend_obs",
]

FACT_COLS = [
    "game_id", "platform_code", "obs_date",
    "days_since_release", "days_since_release_log", "launch_phase", "is_new_release",
    "current_price_usd", "original_price_usd", "discount_pct", "is_on_sale", "sale_event_name",
    "lowest_price_usd", "decay_factor", "price_vs_launch", "launch_price_decay", "price_change_abs",
    "price_change_pct", "price_7obs_avg", "price_30obs_avg", "price_volatility", "price_all_time_low",
    "is_all_time_low", "discount_frequency_proxy", "discount_intensity", "affordability_index",
    "price_na", "price_eu", "price_gb", "price_jp", "price_br", "price_au",
    "concurrent_players", "peak_ccu_alltime", "ccu_7obs_avg", "ccu_30obs_avg", "player_growth_rate",
    "review_count", "positive_reviews", "negative_reviews", "steam_rating_pct", "user_score",
    "metacritic_score", "wishlist_count", "twitch_viewers_proxy", "youtube_views_proxy",
    "reddit_mentions", "social_hype_index", "hype_score", "virality_score", "influencer_boost_proxy",
    "popularity_momentum", "review_velocity", "review_growth_rate",
    "estimated_units_sold", "estimated_revenue_usd", "revenue_per_review", "revenue_per_player",
    "revenue_cumulative", "units_cumulative", "monetisation_intensity", "revenue_momentum_4w",
    "has_controversy", "controversy_day", "controversy_score", "engagement_to_price",
    "review_times_rating", "critic_user_gap", "sentiment_stability", "community_health_score",
    "tier_label", "genre_popularity_rank", "platform_popularity_rank",
    "rating_drop_flag", "fake_discount_flag", "player_spike_flag", "review_inflation_flag",
    "target_ccu_next_4w", "target_revenue_next_4w", "target_price_next_4w",
    "target_review_count_next_4w", "target_is_on_sale_next_obs", "target_breakout_hit",
    "target_sleeper_hit", "target_long_tail",
    # row identity (not published: a stable observation key for seeded sampling)
    "obs_key",
]

STAR_TABLES = {
    "dim_games": (GAME_KEY, DIM_GAMES_COLS),
    "dim_platform": (PLATFORM_KEY, DIM_PLATFORM_COLS),
    "dim_time": (TIME_KEY, DIM_TIME_COLS),
}

STAR_TABLE_ORDER = ["dim_games", "dim_platform", "dim_time", "fact_weekly_metrics"]

# Modelling subset: identifiers and the second target are dropped before
# training, the categorical columns are label-encoded, the rest are numeric.
MODEL_COLS = [
    "obs_key",
    "game_id",
    "game_name",
    "publisher",
    "genre_code",
    "target_revenue_next_4w",
    "genre",
    "platform_code",
    "publisher_tier",
    "target_breakout_hit",
    "is_aaa",
    "publisher_avg_budget",
    "is_multiplayer",
    "concurrent_players",
    "hype_score",
    "twitch_viewers_proxy",
    "base_price_usd",
    "is_indie",
    "steam_rating_pct",
    "current_price_usd",
    "discount_pct",
    "days_since_release",
]
