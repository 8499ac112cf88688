"""The flat source moves narrow line rows, once; hot games and repeated parts give the rows of the plain definition."""

import datetime
import pathlib
import random
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.numeric import growth_rate
from tessera.plans import queries as Q
from tessera.sources import observations as obs
from tessera.sources import stage


def _tables(spark, root, twice=False):
    rnd = random.Random(5)
    lines = [(i // 3, i % 3, 1 if i % 2 else rnd.randint(2, 30), rnd.randint(1, 9), float(rnd.randint(1, 50)), 100.0 + i, 0.05, 0.02, "N", "O",
              datetime.datetime(2020, 1, 1) + datetime.timedelta(days=rnd.randint(0, 40))) for i in range(900)]
    lines.append((999, 0, None, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", None))
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    parts = [(i, f"p{i}", f"Brand#{i % 5}", "PROMO", i % 50, 10.0 + i) for i in range(1, 28)]
    parts += [(1, "p1 again", "Brand#1", "PROMO", 3, 11.0), (2, "p2", "Brand#2", "PROMO", 2, 12.0)] if twice else []
    for name, rows, schema in (("lineitem", lines, names), ("part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
                               ("supplier", [(i, i % 4) for i in range(8)], "s_suppkey long, s_nationkey int"),
                               ("nation", [(i, f"n{i}", i % 2) for i in range(4)], "n_nationkey int, n_name string, n_regionkey int"),
                               ("region", [(0, "r0"), (1, "r1")], "r_regionkey int, r_name string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_hot_games_give_the_same_rows(spark, tmp_path, monkeypatch):
    root = _tables(spark, tmp_path)
    want = _rows(obs.observations(spark, root))
    monkeypatch.setattr(obs, "HOT_GAME_ROWS", 100)  # game 1 holds half of the lines
    assert _rows(obs.observations(spark, root)) == want and len(want) > 600


def test_repeated_parts_repeat_lines_that_follow_themselves(spark, tmp_path, monkeypatch):
    root = _tables(spark, tmp_path, twice=True)
    got = obs.observations(spark, root).select("game_id", "obs_key", "player_growth_rate")
    li = spark.read.parquet(f"{root}/lineitem.parquet").withColumn("obs_date", F.to_date("l_shipdate")).filter("l_suppkey < 8")
    rows = li.join(spark.read.parquet(f"{root}/part.parquet"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.withColumn("players", F.col("l_quantity").cast("long") - 1)
    prev = F.lag("players").over(Window.partitionBy("l_partkey").orderBy("obs_date", *obs.LINE_ORDER))
    key = obs.observation_key({c: F.col(c) for c in rows.columns})
    want = rows.select(F.col("l_partkey").alias("game_id"), key.alias("obs_key"), growth_rate(F.col("players"), prev).alias("player_growth_rate"))
    assert _rows(got) == _rows(want)
    monkeypatch.setattr(obs, "HOT_GAME_ROWS", 100)
    assert _rows(obs.observations(spark, root).select(*want.columns)) == _rows(want)


def test_line_rows_are_shuffled_once_and_narrow(spark, sf_small, monkeypatch):
    from tessera.operators import joins

    for module in (joins, obs):
        monkeypatch.setattr(module, "MAX_BROADCAST_ROWS", 30)  # games over the bound, as with 1 GB
    plan = obs.observations(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(game_id#\d+L?, obs_date", plan)
    assert plan.count("REPARTITION_BY_COL") == 1 and "Exchange hashpartitioning(l_partkey" in plan


def test_fact_is_written_without_a_shuffle(spark, sf_small, monkeypatch):
    from pyspark.sql import DataFrame

    def no(*_):
        raise AssertionError("the fact table is shuffled whole")

    monkeypatch.setattr(DataFrame, "repartitionByRange", no)
    st = stage.build_stage(spark, sf_small, f"{stage.work_dir(spark)}/narrow-test-{random.random()}")
    assert st.counts["fact_weekly_metrics"] == st.counts["observations"] > 0


def _files(folder):
    return [f.name for f in pathlib.Path(folder.removeprefix("file:")).iterdir() if f.name.startswith("part-")]


def test_csv_source_is_packed_and_read_whole(spark, sf_small, tmp_path):
    from tessera.sources import files

    rows = spark.range(1000).select("id", F.concat(F.lit('a "q",\n'), F.col("id").cast("string")).alias("t"))
    files.write_csv(rows, str(tmp_path / "out"), compression="gzip", rows_per_file=100)
    found = _files(str(tmp_path / "out"))
    assert len(found) >= 10 and all(f.endswith(".csv.gz") for f in found)
    assert files.read_csv(spark, str(tmp_path / "out"), rows.schema).exceptAll(rows).count() == 0
    assert files.read_csv(spark, str(tmp_path / "out")).schema["id"].dataType.typeName() == "integer"
    assert all(f.endswith(".csv.gz") for f in _files(Q.observations_csv(spark, sf_small)))


def test_split_is_packed_and_looks_up_codes_last(spark, sf_small, monkeypatch):
    seen = []
    encode = Q.features.label_encode
    monkeypatch.setattr(Q.features, "label_encode", lambda df, *a: (seen.append(df.columns), encode(df, *a))[1])
    monkeypatch.setattr(Q, "_model_version", lambda: f"test-{random.random()}")
    monkeypatch.setattr(Q, "_PREPARED", {})
    found = Q.prepared(spark, sf_small)
    assert all("zstd" in f for f in _files(found.split_path)) and "split" in seen[0]
    assert spark.read.parquet(found.split_path).columns == [*Q.MODEL_COLS, "split"]
