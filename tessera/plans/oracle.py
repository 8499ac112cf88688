"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement recomputes the observation recast and star schema as CTEs over
the driver's tables, then answers the question in plain SQL.  ROUND on
decimals of fifteen places settles exact ties; plain ROUND serves non-finite values.
"""

from __future__ import annotations

from tessera.plans.oracle_base import (
    DIM_GAMES_COLS,
    DIM_PLATFORM_COLS,
    DIM_TIME_COLS,
    FACT_COLS,
    FLAT_CTES,
    STAR_CTES,
    with_star,
)
from tessera.sources.observations import FLAT_COLS

# Fixed values, written out again here on purpose: a slip in the library's own shows as a mismatch.
PHASE_ORDER = ["launch_week", "launch_month", "launch_quarter", "first_year", "second_year", "long_tail"]
DISCOUNT_BUCKETS = [("0% (no discount)", None, None), ("1-9%", 0, 10), ("10-24%", 10, 25), ("25-49%", 25, 50),
                    ("50-74%", 50, 75), ("75%+", None, None)]
EXPECTED_MIN_ROWS = {"dim_games": 9_000, "dim_platform": 6, "dim_time": 2_000, "fact_weekly_metrics": 5_000_000}
STAR_TABLE_ORDER = ["dim_games", "dim_platform", "dim_time", "fact_weekly_metrics"]
RANDOM_STATE, SAMPLE_SIZE, TARGET_COL = 42, 200_000, "target_breakout_hit"
CAT_COLS = ["genre", "platform_code", "publisher_tier"]
FEATURES = ["genre", "platform_code", "publisher_tier", "is_aaa", "publisher_avg_budget", "is_multiplayer",
            "concurrent_players", "hype_score", "twitch_viewers_proxy", "base_price_usd", "is_indie",
            "steam_rating_pct", "current_price_usd", "discount_pct", "days_since_release"]
MODEL_COLS = ["obs_key", "game_id", "game_name", "publisher", "genre_code", "target_revenue_next_4w", TARGET_COL, *FEATURES]

DEMO_SAMPLE_SIZE = 5_000
SCORE_THRESHOLD = 0.7
# The test part as a fraction.
TEST_NUM, TEST_DEN = 2, 10

_DOUBLE_FLAT = {
    "base_price_usd", "publisher_avg_budget", "current_price_usd", "discount_pct", "player_growth_rate",
    "steam_rating_pct", "twitch_viewers_proxy", "hype_score", "estimated_revenue_usd", "target_revenue_next_4w",
}
# Floating columns of the fact table.
FACT_MEASURES = ["current_price_usd", "discount_pct", "player_growth_rate", "steam_rating_pct", "twitch_viewers_proxy", "hype_score",
                 "estimated_revenue_usd", "target_revenue_next_4w"]
_DOUBLE_MODEL = _DOUBLE_FLAT & set(MODEL_COLS)


def r(expr: str, digits: int) -> str:
    """ROUND with exact decimal ties up; values out of the decimal's range by plain ROUND."""
    x = f"CAST({expr} AS DOUBLE)"
    return f"CASE WHEN abs({x}) < 1e20 THEN CAST(ROUND(TRY_CAST({x} AS DECIMAL(38, 15)), {digits}) AS DOUBLE) ELSE ROUND({x}, {digits}) END"


def bucket_sql(col: str = "discount_pct") -> str:
    labels = [label for label, _, _ in DISCOUNT_BUCKETS]
    parts = [f"WHEN {col} = 0 THEN '{labels[0]}'"]
    for label, low, high in DISCOUNT_BUCKETS[1:-1]:
        op = ">" if low == 0 else ">="
        parts.append(f"WHEN {col} {op} {low} AND {col} < {high} THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{labels[-1]}' END"


def phase_rank_sql(col: str = "launch_phase") -> str:
    whens = " ".join(f"WHEN '{p}' THEN {i + 1}" for i, p in enumerate(PHASE_ORDER))
    return f"CAST(CASE {col} {whens} ELSE NULL END AS INTEGER)"


# Modelling CTEs: subset -> seeded exact sample -> label encoding -> stratified split.
_ENC = ",\n        ".join(
    f"CAST(DENSE_RANK() OVER (ORDER BY COALESCE(CAST({c} AS VARCHAR), 'nan')) - 1 AS INTEGER) AS {c}"
    for c in CAT_COLS
)
_KEEP = ", ".join(c for c in MODEL_COLS if c not in CAT_COLS)
MODEL_CTES = f"""model_frame AS (
    SELECT {', '.join(MODEL_COLS)} FROM flat
),
encoded AS (
    SELECT {_KEEP},
        {_ENC}
    FROM model_frame
),
class_sizes AS (
    SELECT {TARGET_COL} AS cls, COUNT(*) AS n_c, CAST({TEST_NUM} AS BIGINT) * COUNT(*) AS part,
        CAST(CEIL(CAST({TEST_NUM} * SUM(COUNT(*)) OVER () AS DECIMAL(38, 3)) / {TEST_DEN}) AS BIGINT) AS total
    FROM encoded GROUP BY 1
),
quotas AS (
    SELECT cls, part // {TEST_DEN} + CAST(ROW_NUMBER() OVER (ORDER BY part % {TEST_DEN} DESC, CAST(cls AS VARCHAR))
        <= total - SUM(part // {TEST_DEN}) OVER () AS BIGINT) AS quota
    FROM class_sizes
),
model_split AS (
    SELECT encoded.*,
        CASE WHEN ROW_NUMBER() OVER (PARTITION BY {TARGET_COL}
                                     ORDER BY md5(concat_ws('|', '{RANDOM_STATE}', 'split', obs_key)))
                  <= quota
             THEN 'test' ELSE 'train' END AS split
    FROM encoded JOIN quotas ON cls = {TARGET_COL}
),
scored_test AS (
    SELECT obs_key, {TARGET_COL} AS label,
        CAST(concurrent_players AS DOUBLE) / 49 * CAST(0.5 AS DOUBLE) + hype_score * 5
            + is_aaa * CAST(0.3 AS DOUBLE) AS score
    FROM model_split WHERE split = 'test'
),
scored AS (
    SELECT *, CAST(score >= {SCORE_THRESHOLD} AS INTEGER) AS prediction FROM scored_test
)"""


def with_model(select_sql: str) -> str:
    return f"WITH {FLAT_CTES},\n{STAR_CTES},\n{MODEL_CTES}\n{select_sql}"


def _count_union(names: list[str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {n}"
                                for n in names)


def _fd_audit_sql() -> str:
    parts = []
    for table, key, cols in (("dim_games", "game_id", DIM_GAMES_COLS), ("dim_platform", "platform_code", DIM_PLATFORM_COLS),
                             ("dim_time", "obs_date", DIM_TIME_COLS)):
        for c in cols:
            if c == key:
                continue
            parts.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(COUNT(*) AS BIGINT) AS conflicting_keys "
                f"FROM (SELECT {key} FROM flat GROUP BY {key} HAVING COUNT(DISTINCT {c}) > 1)"
            )
    return "\nUNION ALL\n".join(parts)


def _fd_conflicts_sql() -> str:
    parts = []
    for table, key, cols in (("dim_games", "game_id", DIM_GAMES_COLS), ("dim_platform", "platform_code", DIM_PLATFORM_COLS),
                             ("dim_time", "obs_date", DIM_TIME_COLS),
                             ("publishers", "publisher", ["publisher_tier", "genre", "genre_code"])):
        for c in cols:
            if c == key:
                continue
            parts.append(
                f"""SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(k AS VARCHAR) AS key_value,
    CAST(COUNT(*) AS BIGINT) AS n_values, CAST(MIN(v) AS VARCHAR) AS low, CAST(arg_min(n, v) AS BIGINT) AS n_low,
    CAST(MAX(v) AS VARCHAR) AS high, CAST(arg_max(n, v) AS BIGINT) AS n_high
    FROM (SELECT {key} AS k, {c} AS v, COUNT(*) AS n FROM flat WHERE {c} IS NOT NULL GROUP BY 1, 2) GROUP BY k HAVING COUNT(*) > 1"""
            )
    return "\nUNION ALL\n".join(parts)


def _profile_sql() -> str:
    parts = []
    for c in FLAT_COLS:
        odd = [f"CAST(COUNT(*) FILTER (WHERE {test}) AS BIGINT)" if c in _DOUBLE_FLAT else "CAST(0 AS BIGINT)"
               for test in (f"isnan({c})", f"{c} = CAST('inf' AS DOUBLE)", f"{c} = CAST('-inf' AS DOUBLE)")]
        parts.append(f"SELECT '{c}' AS column_name, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS n_null, "
                     f"{odd[0]} AS n_nan, {odd[1]} AS n_pos_inf, {odd[2]} AS n_neg_inf FROM flat")
    return "\nUNION ALL\n".join(parts)


def _null_counts_sql(table: str, cols: list[str], doubles: set[str]) -> str:
    parts = []
    for c in cols:
        cond = f"{c} IS NULL OR isnan({c})" if c in doubles else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS column_name, CAST(COALESCE(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT)"
                     f" AS null_count FROM {table}")
    return "SELECT * FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) WHERE null_count > 0"


def _nonfinite_sql() -> str:
    parts = []
    for c in FACT_MEASURES:
        parts.append(
            f"SELECT '{c}' AS column_name, "
            f"CAST(COALESCE(SUM(CASE WHEN {c} = CAST('inf' AS DOUBLE) THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_pos_inf, "
            f"CAST(COALESCE(SUM(CASE WHEN {c} = CAST('-inf' AS DOUBLE) THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_neg_inf, "
            f"CAST(COALESCE(SUM(CASE WHEN isnan({c}) THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_nan, "
            f"CAST(COALESCE(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_null "
            f"FROM fact_weekly_metrics"
        )
    return "\nUNION ALL\n".join(parts)


_TYPE_MAP = ("CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
             "WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' WHEN 'BOOLEAN' THEN 'boolean' "
             "ELSE lower(column_type) END")

_GENRE = f"""SELECT g.genre,
        CAST(COUNT(DISTINCT f.game_id) AS BIGINT) AS game_count,
        {r('AVG(f.estimated_revenue_usd)', 2)} AS avg_weekly_revenue,
        {r('MEDIAN(f.estimated_revenue_usd)', 2)} AS median_weekly_revenue,
        {r('AVG(f.concurrent_players)', 0)} AS avg_players
    FROM fact_weekly_metrics f JOIN dim_games g ON f.game_id = g.game_id
    GROUP BY g.genre"""

_LIFECYCLE = f"""SELECT launch_phase,
        {r('AVG(concurrent_players)', 0)} AS avg_players,
        {r('AVG(estimated_revenue_usd)', 2)} AS avg_revenue,
        {r('AVG(hype_score)', 3)} AS avg_hype,
        {r('AVG(discount_pct)', 3)} AS avg_discount,
        CAST(COUNT(*) AS BIGINT) AS observation_count
    FROM fact_weekly_metrics
    WHERE launch_phase IS NOT NULL
    GROUP BY launch_phase"""

_PLATFORM = f"""SELECT p.platform, p.platform_code,
        {r('AVG(f.concurrent_players)', 0)} AS avg_players,
        {r('AVG(f.estimated_revenue_usd)', 2)} AS avg_revenue,
        {r('AVG(f.hype_score)', 3)} AS avg_hype,
        {r('AVG(f.discount_pct)', 3)} AS avg_discount,
        {r('AVG(f.steam_rating_pct)', 3)} AS avg_rating,
        CAST(COUNT(DISTINCT f.game_id) AS BIGINT) AS unique_games
    FROM fact_weekly_metrics f JOIN dim_platform p ON f.platform_code = p.platform_code
    GROUP BY p.platform, p.platform_code"""

_DISCOUNT = f"""SELECT {bucket_sql()} AS discount_bucket,
        {r('AVG(concurrent_players)', 0)} AS avg_players,
        {r('AVG(estimated_revenue_usd)', 2)} AS avg_revenue,
        ROUND(AVG(player_growth_rate), 4) AS avg_player_growth,
        CAST(COUNT(*) AS BIGINT) AS observation_count
    FROM fact_weekly_metrics
    GROUP BY discount_bucket
    ORDER BY MIN(discount_pct)"""

_DISCOUNT_CLEAN = f"""SELECT {bucket_sql()} AS discount_bucket,
        {r('AVG(concurrent_players)', 0)} AS avg_players,
        {r('AVG(estimated_revenue_usd)', 2)} AS avg_revenue,
        {r('AVG(CASE WHEN isfinite(player_growth_rate) THEN player_growth_rate END)', 4)} AS avg_player_growth,
        CAST(COUNT(*) AS BIGINT) AS observation_count
    FROM fact_weekly_metrics
    GROUP BY discount_bucket"""

_AUC = """SELECT CAST(ROUND(CAST(SUM(pos * (below + 0.5 * neg)) / (SUM(pos) * SUM(neg)) AS DECIMAL(38, 6)), 6)
            AS DOUBLE) AS roc_auc
    FROM (
        SELECT pos, neg,
            COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT score, CAST(SUM(label) AS DOUBLE) AS pos, CAST(SUM(1 - label) AS DOUBLE) AS neg
              FROM scored_test GROUP BY score)
    )"""

_REPORT = """SELECT label, precision, recall, f1_score, support FROM (
    WITH c AS (
        SELECT CAST(SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
               CAST(SUM(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
               CAST(SUM(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
               CAST(SUM(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn
        FROM scored
    ), m AS (
        SELECT *,
            CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0,
            CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0,
            CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1,
            CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
            tn + fp AS s0, tp + fn AS s1
        FROM c
    ), f AS (
        SELECT *,
            CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
            CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1,
            s0 + s1 AS n
        FROM m
    )
    SELECT 0 AS o, 'Not Breakout' AS label, ROUNDX(p0) AS precision, ROUNDX(r0) AS recall, ROUNDX(f0) AS f1_score,
           CAST(s0 AS BIGINT) AS support FROM f
    UNION ALL SELECT 1, 'Breakout Hit', ROUNDX(p1), ROUNDX(r1), ROUNDX(f1), CAST(s1 AS BIGINT) FROM f
    UNION ALL SELECT 2, 'accuracy', NULL, NULL, ROUNDX(CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END),
           CAST(n AS BIGINT) FROM f
    UNION ALL SELECT 3, 'macro avg', ROUNDX((p0 + p1) / 2), ROUNDX((r0 + r1) / 2), ROUNDX((f0 + f1) / 2),
           CAST(n AS BIGINT) FROM f
    UNION ALL SELECT 4, 'weighted avg',
           ROUNDX(CASE WHEN n = 0 THEN 0.0 ELSE (p0 * s0 + p1 * s1) / n END),
           ROUNDX(CASE WHEN n = 0 THEN 0.0 ELSE (r0 * s0 + r1 * s1) / n END),
           ROUNDX(CASE WHEN n = 0 THEN 0.0 ELSE (f0 * s0 + f1 * s1) / n END),
           CAST(n AS BIGINT) FROM f
) ORDER BY o"""


def _roundx(sql: str, digits: int = 4) -> str:
    """Expand ROUNDX(expr) into the decimal rounding rule (balanced-paren aware)."""
    out, i = [], 0
    token = "ROUNDX("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        k, depth = j + len(token), 1
        while depth:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
            k += 1
        inner = sql[j + len(token):k - 1]
        out.append(r(inner, digits))
        i = k


def _frame_shape_sql() -> str:
    n_feat = len(FEATURES)
    return f"""SELECT 'full' AS frame, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST({len(MODEL_COLS)} AS INTEGER) AS n_columns FROM model_frame
    UNION ALL SELECT 'fit', CAST(LEAST(COUNT(*), {SAMPLE_SIZE}) AS BIGINT), CAST({n_feat} AS INTEGER) FROM model_split WHERE split = 'train'
    UNION ALL SELECT 'train', CAST(COUNT(*) AS BIGINT), CAST({n_feat} AS INTEGER) FROM model_split WHERE split = 'train'
    UNION ALL SELECT 'test', CAST(COUNT(*) AS BIGINT), CAST({n_feat} AS INTEGER) FROM model_split WHERE split = 'test'"""


def _minimums_values() -> str:
    return ", ".join(f"('{k}', CAST({v} AS BIGINT))" for k, v in EXPECTED_MIN_ROWS.items())


def _label_map_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, label, CAST(DENSE_RANK() OVER (ORDER BY label) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT COALESCE(CAST({c} AS VARCHAR), 'nan') AS label FROM model_frame)"
        for c in CAT_COLS
    ]
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    fact_list = ", ".join(FACT_COLS)
    q: dict[str, str] = {
        "observations": with_star(f"SELECT {', '.join(FLAT_COLS)} FROM flat"),
        "fact_weekly_metrics": with_star(f"SELECT {fact_list} FROM fact_weekly_metrics"),
        "dim_games": with_star("SELECT * FROM dim_games"),
        "dim_platform": with_star("SELECT * FROM dim_platform"),
        "dim_time": with_star("SELECT * FROM dim_time"),
        "fd_audit": with_star(_fd_audit_sql()),
        "fd_conflicts": with_star(_fd_conflicts_sql()),
        "column_profile": with_star(_profile_sql()),
        "unique_games": with_star(
            """SELECT CASE WHEN GROUPING(platform_code) = 0 AND GROUPING(launch_phase) = 0 THEN 'platform_phase'
            WHEN GROUPING(platform_code) = 0 THEN 'platform' WHEN GROUPING(launch_phase) = 0 THEN 'phase' ELSE 'all' END AS level,
        platform_code, launch_phase, CAST(COUNT(DISTINCT game_id) AS BIGINT) AS unique_games
    FROM fact_weekly_metrics GROUP BY GROUPING SETS ((platform_code, launch_phase), (platform_code), (launch_phase), ())"""),
        "row_counts": with_star(_count_union(STAR_TABLE_ORDER)),
        "row_count_check": with_star(
            f"""SELECT e.table_name, c.row_count, e.minimum, COALESCE(c.row_count >= e.minimum, FALSE) AS passed
    FROM (VALUES {_minimums_values()}) e(table_name, minimum)
    LEFT JOIN ({_count_union(STAR_TABLE_ORDER)}) c ON e.table_name = c.table_name"""
        ),
        "verification_passed": with_star(
            f"""SELECT bool_and(COALESCE(c.row_count >= e.minimum, FALSE)) AS all_passed
    FROM (VALUES {_minimums_values()}) e(table_name, minimum)
    LEFT JOIN ({_count_union(STAR_TABLE_ORDER)}) c ON e.table_name = c.table_name"""
        ),
        "verification_report": with_star(
            f"""SELECT 'row_count_check' AS section, e.table_name AS item,
        CASE WHEN c.row_count >= e.minimum THEN 'passed' ELSE 'failed' END AS detail, CAST(c.row_count AS DOUBLE) AS value
    FROM (VALUES {_minimums_values()}) e(table_name, minimum)
    LEFT JOIN ({_count_union(STAR_TABLE_ORDER)}) c ON e.table_name = c.table_name
    UNION ALL SELECT 'platforms', platform, storefront, CAST(platform_code AS DOUBLE) FROM dim_platform
    UNION ALL SELECT * FROM (SELECT 'sample_games', game_name, genre, CAST(release_year AS DOUBLE) FROM dim_games ORDER BY game_id LIMIT 5)
    UNION ALL SELECT 'revenue_sanity', 'avg_revenue', NULL, {r('AVG(estimated_revenue_usd)', 2)} FROM fact_weekly_metrics
    UNION ALL SELECT 'revenue_sanity', 'max_revenue', NULL, {r('MAX(estimated_revenue_usd)', 2)} FROM fact_weekly_metrics
    UNION ALL SELECT 'revenue_sanity', 'avg_price', NULL, {r('AVG(current_price_usd)', 2)} FROM fact_weekly_metrics
    UNION ALL SELECT 'revenue_sanity', 'avg_players', NULL, {r('AVG(concurrent_players)', 0)} FROM fact_weekly_metrics"""),
        "feature_columns": "SELECT * FROM (VALUES " + ", ".join(
            f"('{name}', CAST({i} AS INTEGER), '{c}')"
            for name, cols in (("v1", FEATURES), ("v2", [c for c in FEATURES if c != "is_aaa"])) for i, c in enumerate(cols, 1)
        ) + ") f(feature_set, position, feature)",
        "star_round_trip": with_star("\nUNION ALL\n".join(
            f"SELECT '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count, "
            f"CAST({len(cols)} AS INTEGER) AS n_columns FROM {n}"
            for n, cols in (("dim_games", DIM_GAMES_COLS), ("dim_platform", DIM_PLATFORM_COLS),
                            ("dim_time", DIM_TIME_COLS), ("fact_weekly_metrics", FACT_COLS))
        )),
        "platform_list": with_star(
            "SELECT platform_code, platform, storefront FROM dim_platform ORDER BY platform NULLS LAST"),
        "sample_games": with_star(
            """SELECT game_name, genre, CAST(is_indie AS INTEGER) AS is_indie, CAST(is_aaa AS INTEGER) AS is_aaa,
        CAST(release_year AS INTEGER) AS release_year
    FROM dim_games ORDER BY game_id LIMIT 5"""),
        "revenue_sanity": with_star(
            f"""SELECT {r('AVG(estimated_revenue_usd)', 2)} AS avg_revenue,
        {r('MAX(estimated_revenue_usd)', 2)} AS max_revenue,
        {r('AVG(current_price_usd)', 2)} AS avg_price,
        {r('AVG(concurrent_players)', 0)} AS avg_players
    FROM fact_weekly_metrics"""),
        "genre_revenue": with_star(f"{_GENRE}\n    ORDER BY avg_weekly_revenue DESC, genre LIMIT 15"),
        "genre_chart_series": with_star(
            f"SELECT genre, avg_weekly_revenue / 1000000 AS avg_weekly_revenue_musd FROM ({_GENRE}\n"
            f"    ORDER BY avg_weekly_revenue DESC, genre LIMIT 15)"),
        "genre_skew": with_star(
            f"SELECT genre, avg_weekly_revenue, median_weekly_revenue, "
            f"{r('avg_weekly_revenue / median_weekly_revenue', 3)} AS mean_to_median FROM ({_GENRE})"),
        "lifecycle": with_star(f"{_LIFECYCLE}\n    ORDER BY avg_players DESC"),
        "lifecycle_ordered": with_star(
            f"SELECT *, {phase_rank_sql()} AS phase_order FROM ({_LIFECYCLE}) ORDER BY phase_order NULLS LAST"),
        "lifecycle_chart_series": with_star(
            f"SELECT launch_phase, {phase_rank_sql()} AS phase_order, avg_players / 1000 AS avg_players_k, "
            f"avg_revenue / 1000000 AS avg_revenue_musd FROM ({_LIFECYCLE})"),
        "platform_comparison": with_star(f"{_PLATFORM}\n    ORDER BY avg_players DESC"),
        "platform_report": with_star(
            f"SELECT platform, avg_players, avg_revenue, avg_rating, avg_discount, unique_games FROM ({_PLATFORM})"),
        "platform_chart_series": with_star(
            f"SELECT platform, avg_players / 1000 AS avg_players_k, avg_revenue / 1000000 AS avg_revenue_musd "
            f"FROM ({_PLATFORM})"),
        "discount_effect": with_star(_DISCOUNT),
        "discount_effect_clean": with_star(_DISCOUNT_CLEAN),
        "discount_bucket_edges": with_star(
            f"""SELECT {bucket_sql()} AS discount_bucket,
        MIN(discount_pct) AS min_discount, MAX(discount_pct) AS max_discount,
        CAST(COUNT(*) AS BIGINT) AS observation_count, CAST(COUNT(discount_pct) AS BIGINT) AS non_null_count
    FROM fact_weekly_metrics GROUP BY discount_bucket"""),
        "discount_chart_series": with_star(
            f"SELECT discount_bucket, avg_players / 1000 AS avg_players_k, avg_revenue / 1000000 AS avg_revenue_musd "
            f"FROM ({_DISCOUNT})"),
        "discount_by_phase": with_star(
            f"""SELECT {bucket_sql()} AS discount_bucket, launch_phase,
        CAST(COUNT(*) AS BIGINT) AS observation_count, {r('AVG(concurrent_players)', 0)} AS avg_players
    FROM fact_weekly_metrics GROUP BY discount_bucket, launch_phase"""),
        "flag_label_crosstab": with_star(
            """SELECT CAST(is_indie AS INTEGER) AS flag_value, CAST(publisher_tier = 'Indie' AS INTEGER) AS label_matches,
        CAST(COUNT(*) AS BIGINT) AS n_games
    FROM dim_games GROUP BY 1, 2"""),
        "calendar_rollup": with_star(
            f"""SELECT t.obs_year, t.obs_quarter, CAST(COUNT(*) AS BIGINT) AS observation_count,
        {r('AVG(f.estimated_revenue_usd)', 2)} AS avg_revenue,
        {r('AVG(f.concurrent_players)', 0)} AS avg_players,
        {r('AVG(f.discount_pct)', 3)} AS avg_discount
    FROM fact_weekly_metrics f JOIN dim_time t ON f.obs_date = t.obs_date
    GROUP BY t.obs_year, t.obs_quarter"""),
        "nonfinite_audit": with_star(_nonfinite_sql()),
        "observation_null_counts": with_star(_null_counts_sql("flat", FLAT_COLS, _DOUBLE_FLAT)),
        "null_counts": with_model(_null_counts_sql("model_frame", MODEL_COLS, _DOUBLE_MODEL)),
        "target_distribution": with_model(
            f"""SELECT {TARGET_COL}, {r('CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER ()', 3)} AS proportion
    FROM model_frame WHERE {TARGET_COL} IS NOT NULL GROUP BY {TARGET_COL}"""),
        "sample_target_distribution": with_model(
            f"""SELECT {TARGET_COL}, {r('CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER ()', 3)} AS proportion
    FROM model_split WHERE split = 'train' AND {TARGET_COL} IS NOT NULL GROUP BY {TARGET_COL}"""),
        "frame_shape": with_model(_frame_shape_sql()),
        "exact_sample": with_model(
            f"""SELECT obs_key, game_id, {TARGET_COL} FROM model_frame
    ORDER BY md5(concat_ws('|', '{RANDOM_STATE}', 'sample', obs_key)) LIMIT {DEMO_SAMPLE_SIZE}"""),
        "stratified_split": with_model(f"SELECT obs_key, {TARGET_COL}, split FROM model_split"),
        "split_balance": with_model(
            f"SELECT split, {TARGET_COL}, CAST(COUNT(*) AS BIGINT) AS n_rows FROM model_split GROUP BY 1, 2"),
        "label_map": with_model(_label_map_sql()),
        "label_encode": with_model(f"SELECT obs_key, {', '.join(CAT_COLS)} FROM model_split"),
        "class_weights": with_model(
            f"""SELECT CAST(COUNT(*) AS BIGINT) AS n_rows,
        CAST(SUM(CASE WHEN {TARGET_COL} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_negative,
        CAST(SUM(CASE WHEN {TARGET_COL} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_positive,
        CAST(COUNT(*) AS DOUBLE) / (2 * SUM(CASE WHEN {TARGET_COL} = 0 THEN 1 ELSE 0 END)) AS weight_negative,
        CAST(COUNT(*) AS DOUBLE) / (2 * SUM(CASE WHEN {TARGET_COL} = 1 THEN 1 ELSE 0 END)) AS weight_positive,
        CAST(SUM(CASE WHEN {TARGET_COL} = 0 THEN 1 ELSE 0 END) AS DOUBLE)
            / SUM(CASE WHEN {TARGET_COL} = 1 THEN 1 ELSE 0 END) AS scale_pos_weight
    FROM model_split WHERE split = 'train'"""),
        "classification_report": with_model(_roundx(_REPORT)),
        "roc_auc": with_model(_AUC),
        "describe_source": f"""SELECT CAST(ROW_NUMBER() OVER () AS INTEGER) AS ordinal, column_name,
        {_TYPE_MAP} AS column_type
    FROM (DESCRIBE (WITH {FLAT_CTES} SELECT {', '.join(FLAT_COLS)} FROM flat))""",
        "source_width": f"""SELECT CAST(COUNT(*) AS INTEGER) AS n_columns
    FROM (DESCRIBE (WITH {FLAT_CTES} SELECT {', '.join(FLAT_COLS)} FROM flat))""",
        "csv_round_trip": with_star(f"SELECT {', '.join(FLAT_COLS)} FROM flat"),
        "describe_csv_source": with_star(" UNION ALL ".join(
            f"""SELECT {i} AS ordinal, '{c}' AS column_name, CASE WHEN COUNT({c}) = 0 THEN 'string'
            WHEN any_value(typeof({c})) IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT') THEN CASE WHEN MAX(abs(TRY_CAST({c}::VARCHAR AS HUGEINT))) <= 2147483647 THEN 'int' ELSE 'bigint' END
            WHEN any_value(typeof({c})) IN ('DOUBLE', 'FLOAT') THEN 'double' WHEN any_value(typeof({c})) = 'DATE' THEN 'date'
            WHEN any_value(typeof({c})) = 'BOOLEAN' THEN 'boolean' ELSE 'string' END AS column_type FROM flat""" for i, c in enumerate(FLAT_COLS, 1))),
    }
    return q
