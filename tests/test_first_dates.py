"""First dates, hot games and bitmaps of the games seen need no shuffle of a row per game and task, or of all lines twice."""

import datetime

from tessera.operators import joins, summaries
from tessera.sources import observations as obs
from tessera.sources import stage

from .test_narrow_shuffle import _rows, _tables


def _with_early_lines(spark, root):
    """Lines before all others of their games: without a supplier, or with one that is not there."""
    _tables(spark, root)
    early = [(5000 + i, 0, g, s, 3.0, 50.0, 0.0, 0.0, "N", "O", datetime.datetime(2019, 1, 1 + i)) for i, (g, s) in enumerate([(1, None), (3, 9), (5, 2)])]
    lines = spark.read.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame(early, lines.schema).write.mode("append").parquet(f"{root}/lineitem.parquet")
    return str(root)


def test_first_date_counts_lines_without_a_platform(spark, tmp_path, monkeypatch):
    root = _with_early_lines(spark, tmp_path)
    first = {r["game_id"]: r["release_date"] for r in obs.observations(spark, root).select("game_id", "release_date").distinct().collect()}
    assert [first[g] for g in (1, 3, 5)] == [datetime.date(2019, 1, d) for d in (1, 2, 3)]
    want = _rows(obs.observations(spark, root))
    monkeypatch.setattr(obs, "HOT_GAME_ROWS", 100)
    assert _rows(obs.observations(spark, root)) == want
    monkeypatch.setattr(obs, "HOT_GAME_ROWS", 200_000)
    for module in (joins, obs):
        monkeypatch.setattr(module, "MAX_BROADCAST_ROWS", 3)  # games and suppliers over the bound
    assert _rows(obs.observations(spark, root)) == want


def test_no_row_per_game_is_made_before_the_lines_are_dealt(spark, tmp_path, monkeypatch):
    root = _with_early_lines(spark, tmp_path)
    kept, frame = [], type(spark.range(1))
    checkpoint = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a, **k: (kept.append(self.count()), checkpoint(self, *a, **k))[1])
    obs.observations(spark, root)
    assert kept and max(kept) == 0  # no game is hot
    kept.clear()
    monkeypatch.setattr(obs, "HOT_GAME_ROWS", 100)
    obs.observations(spark, root)
    assert kept[-1] == 1  # game 1 holds half of the lines


def test_rows_of_games_are_dealt_once_for_the_bitmaps(spark, tmp_path, monkeypatch):
    rows = [(g, p, f) for g in range(-3, 40) for p in (0, 1) for f in ("a", None)] + [(7, 1, "a")] * 900 + [(None, 1, "a")]
    df = spark.createDataFrame(rows, "game_id long, platform_code int, launch_phase string")
    df.write.parquet(f"{tmp_path}/fact_weekly_metrics")
    summaries.key_states(df.groupBy("game_id").count().withColumnRenamed("count", "n_rows"), "game_id").write.parquet(f"{tmp_path}/key_states/dim_games")
    want = _rows(summaries.presence(df, stage.PRESENCE_GROUPS, "game_id"))
    seen, presence = [], summaries.presence
    monkeypatch.setattr(summaries, "presence", lambda *a: (seen.append(a), presence(*a))[1])
    for least in (500, 200_000):
        monkeypatch.setattr(stage, "HOT_GAME_ROWS", least)
        stage._write_presence(spark, str(tmp_path))
        assert [r[0] for r in seen[-1][3].collect()] == ([7] if least == 500 else [])
        assert _rows(spark.read.parquet(f"{tmp_path}/games_seen")) == want
        (tmp_path / "games_seen").rename(tmp_path / f"seen-{least}")
    monkeypatch.setattr(stage, "FEW_ROWS_PER_GAME", 2)  # many rows a game: all of them collapse first
    stage._write_presence(spark, str(tmp_path))
    assert seen[-1][3] is None and _rows(spark.read.parquet(f"{tmp_path}/games_seen")) == want
