"""The (game, date)-split growth lag equals a plain per-game lag, also for a hot game."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.numeric import growth_rate
from tessera.sources.observations import LINE_ORDER, _with_growth


def test_split_lag_matches_plain_lag(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(6000):
        game = 1 if i % 3 else rnd.randint(2, 40)  # game 1 holds two thirds of the rows
        day = rnd.randint(0, 60)
        rows.append((game, day, i, rnd.randint(1, 7), rnd.randint(0, 5)))
    df = (
        spark.createDataFrame(rows, "game_id long, d int, l_orderkey long, l_linenumber int, concurrent_players long")
        .withColumn("obs_date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d")))
        .drop("d")
    )
    for c in LINE_ORDER[2:]:
        df = df.withColumn(c, F.lit(0).cast("double") if c not in ("l_returnflag", "l_linestatus") else F.lit("x"))
    got = {r["l_orderkey"]: r["player_growth_rate"] for r in _with_growth(df).collect()}
    w = Window.partitionBy("game_id").orderBy("obs_date", *LINE_ORDER)
    plain = df.withColumn("g", growth_rate(F.col("concurrent_players"), F.lag("concurrent_players").over(w)))
    want = {r["l_orderkey"]: r["g"] for r in plain.collect()}
    assert len(got) == len(want) == 6000
    for k, v in want.items():
        g = got[k]
        assert (v is None and g is None) or (v != v and g != g) or v == g, (k, v, g)


def test_recast_shuffle_join_path_matches_broadcast_path(spark, sf_small, monkeypatch):
    """With every side over the broadcast bound (the large-cluster plan: shuffle joins,
    then the (game, date) repartition) the observation table is unchanged."""
    from tessera.operators import joins
    from tessera.sources import observations as obs

    small = obs.observations(spark, sf_small)
    want = small.collect()
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(obs, "MAX_BROADCAST_ROWS", 0)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")  # what a 20-billion-row dimension gets anyway
        big = obs.observations(spark, sf_small)
        physical = big._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert "SortMergeJoin" in physical and "BroadcastHashJoin" not in physical
        assert big.exceptAll(spark.createDataFrame(want, small.schema)).count() == 0
        assert big.count() == len(want)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
