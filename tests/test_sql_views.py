"""The staged tables answer star-schema SQL unchanged through spark.sql."""

import pytest

from tessera.plans import queries as Q
from tessera.sources import stage

PER_GENRE = """
    WITH weekly AS (SELECT game_id AS id, estimated_revenue_usd AS usd FROM fact_weekly_metrics)
    SELECT genre AS kind, count(DISTINCT id) AS titles, mean(usd) AS mean_usd, median(usd) AS middle_usd
    FROM weekly INNER JOIN dim_games ON id = game_id
    GROUP BY genre
"""


def test_views_run_star_sql(spark, sf_small):
    names = stage.register_views(spark, sf_small)
    assert set(names) >= {"dim_games", "dim_platform", "dim_time", "fact_weekly_metrics"}
    via_sql = {r["kind"]: r for r in spark.sql(PER_GENRE).collect()}
    via_lib = {r["genre"]: r for r in Q.q_genre_revenue(spark, sf_small).collect()}
    assert via_sql.keys() == via_lib.keys()
    for g, r in via_lib.items():
        assert via_sql[g]["titles"] == r["game_count"]
        assert via_sql[g]["mean_usd"] == pytest.approx(r["avg_weekly_revenue"], abs=0.011)
        assert via_sql[g]["middle_usd"] == pytest.approx(r["median_weekly_revenue"], abs=0.011)


def test_genre_report_same_on_shuffle_join_path(spark, sf_small):
    from tessera.operators import reports

    small = {r["genre"]: tuple(r) for r in Q.q_genre_revenue(spark, sf_small).collect()}
    big = reports.genre_revenue(Q.fact(spark, sf_small), Q.dim_games(spark, sf_small), games_rows=10**9)
    assert {r["genre"]: tuple(r) for r in big.collect()} == small


def test_csv_ingest_matches_table_ingest(spark, sf_small, tmp_path):
    """A flat CSV (the raw-file form) staged with stage_csv gives the same star schema."""
    from tessera.operators import reports
    from tessera.sources import files

    src = Q.observations(spark, sf_small).drop("obs_key")
    csv = str(tmp_path / "flat_csv")
    files.write_csv(src, csv)
    st = stage.stage_csv(spark, csv, schema=src.schema, root=str(tmp_path / "stage"), carried=src.columns)
    read = lambda name: spark.read.parquet(st.path(name))
    for name in ("dim_games", "dim_platform", "dim_time", "fact_weekly_metrics"):
        a = Q._t(spark, sf_small, name).drop("obs_key")
        b = read(name).drop("obs_key")
        assert a.columns == b.columns, name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    got = reports.genre_revenue(read("fact_weekly_metrics"), read("dim_games"), st.counts["dim_games"]).collect()
    want = Q.q_genre_revenue(spark, sf_small).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    assert read("observations").select("obs_key").distinct().count() == st.counts["observations"]
