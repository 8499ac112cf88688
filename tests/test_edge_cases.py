"""Cases that the fixtures do not hold: NULL groups, non-finite values, quoted CSV text, odd paths."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.numeric import round_half_up
from tessera.operators import ordered, sampling, star
from tessera.sources import files, stage
from tessera.sources.observations import LINE_ORDER, _with_growth

INF = float("inf")


def test_rounding_ties_and_wide_values(spark):
    df = spark.createDataFrame([(0.2849996,), (0.285,), (-0.285,), (1e35,), (INF,), (None,)], "v double")
    got = [r[0] for r in df.select(round_half_up("v", 2)).collect()]
    assert got == [0.28, 0.29, -0.29, 1e35, INF, None]


@pytest.mark.parametrize("final_rows", [250_000, 2])
def test_median_of_null_group_and_infinities(spark, monkeypatch, final_rows):
    monkeypatch.setattr(ordered, "FINAL_ROWS", final_rows)
    rows = [(None, 10.0), (None, 30.0), (None, 50.0), ("a", INF), ("a", INF), ("null", 1.0), ("b", None)]
    got = {r["g"]: r["m"] for r in ordered.exact_median(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", "m").collect()}
    assert got == {None: 30.0, "a": INF, "null": 1.0}


def test_split_total_and_null_class(spark):
    df = spark.range(21).select(F.md5(F.col("id").cast("string")).alias("obs_key"), (F.col("id") % 3).cast("int").alias("y"))
    assert sampling.stratified_split(df, "y").filter("split = 'test'").count() == 5
    with pytest.raises(ValueError, match="NULL"):
        sampling.stratified_split(df.withColumn("y", F.when(F.col("y") > 0, F.col("y"))), "y").count()


def test_quoted_csv_round_trip(spark, tmp_path):
    rows = [(1, 'say "hi"', 0.5), (2, "two\nlines, one comma", INF), (3, None, None), (4, "back\\slash", float("-inf"))]
    df = spark.createDataFrame(rows, "k int, t string, v double")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), df.schema)
    assert sorted(map(tuple, back.collect())) == rows
    (tmp_path / "raw.csv").write_text('k,t,v\n7,"a ""quoted"" word\nnext",1.5\n')
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "raw.csv"), df.schema).collect()] == [(7, 'a "quoted" word\nnext', 1.5)]


def test_missing_contract_columns(spark):
    df = spark.createDataFrame([(1, "x", 2)], "game_id int, game_name string, other int")
    with pytest.raises(KeyError, match="developer"):
        star.dim_games(df)
    assert star.dim_games(df, df.columns).columns == ["game_id", "game_name"]


def test_row_keys_tell_different_rows_apart(spark):
    df = spark.createDataFrame([("a|b", ""), ("a", "b|"), ("", None), (None, ""), (None, "")], "x string, y string")
    keys = [r["obs_key"] for r in stage.with_row_key(df).collect()]
    assert len(set(keys)) == 4 and keys[3] == keys[4]


def test_growth_keeps_rows_without_date_or_game(spark):
    fields = ["game_id int", "obs_date date", "concurrent_players int"] + [f"{c} long" for c in LINE_ORDER]
    rows = [(1, None, 5, *range(len(LINE_ORDER))), (None, None, 6, *range(len(LINE_ORDER))), (1, None, 7, *range(9, 9 + len(LINE_ORDER)))]
    out = _with_growth(spark.createDataFrame(rows, ", ".join(fields))).collect()
    assert len(out) == 3
    assert sorted(r["player_growth_rate"] for r in out if r["player_growth_rate"] is not None) == [pytest.approx(0.4)]


def test_inventory_of_an_odd_folder(spark, tmp_path):
    root = tmp_path / "a (b)+c"
    (root / "sub").mkdir(parents=True)
    (root / "sub" / "x.csv").write_text("k\n1\n")
    assert [r["relative_path"] for r in files.file_inventory(spark, str(root), "*.csv").collect()] == ["sub/x.csv"]


def test_changed_csv_is_staged_anew(spark, tmp_path):
    path = tmp_path / "obs.csv"
    head = "game_id,platform_code,obs_date,obs_key\n"
    carried = ["game_id", "platform_code", "obs_date"]
    schema = "game_id int, platform_code string, obs_date date, obs_key string"
    path.write_text(head + "1,PC,2020-01-01,k1\n")
    assert stage.stage_csv(spark, str(path), schema, carried=carried).counts["observations"] == 1
    path.write_text(head + "1,PC,2020-01-01,k1\n2,PC,2020-01-01,k2\n")
    assert stage.stage_csv(spark, str(path), schema, carried=carried).counts["observations"] == 2
