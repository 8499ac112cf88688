"""Summaries written with the tables: equal to what a scan gives, mergeable, and read instead of the rows."""

import math
import random

import pytest
from pyspark.sql import DataFrame

from tessera.operators import checks, reports, star, summaries
from tessera.plans import queries
from tessera.schema import STAR_TABLE_ORDER
from tessera.sources import stage


def _rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_profile_counts_and_merges(spark):
    rows = [(1, 1.0, "a"), (2, math.nan, None), (None, math.inf, "b"), (4, -math.inf, None), (5, None, "c"), (5, math.inf, "c")]
    df = spark.createDataFrame(rows, "i int, `d` double, s string")
    want = [("d", 6, 1, 1, 2, 1), ("i", 6, 1, 0, 0, 0), ("s", 6, 2, 0, 0, 0)]
    assert _rows(summaries.column_profile(df)) == want
    parts = [summaries.column_profile(spark.createDataFrame(p, df.schema)) for p in (rows[:2], rows[2:], [])]
    assert _rows(summaries.merge_profiles(parts[0].unionByName(parts[1]).unionByName(parts[2]))) == want
    assert _rows(summaries.null_counts(summaries.column_profile(df))) == _rows(checks.null_counts(df))
    assert _rows(summaries.nonfinite_audit(summaries.column_profile(df), ["d"])) == _rows(checks.nonfinite_audit(df, ["d"]))


FLAT = [("k1", "x", 1, "p"), ("k1", "x", 1, "p"), ("k1", "y", 1, None), ("k1", "z", 1, "p"), ("k2", None, 2, "q"), ("k2", "x", 2, "q"),
        (None, "x", 3, None), (None, "y", 3, None), ("k3", None, None, None)]


def test_key_states_name_conflicts(spark):
    flat = spark.createDataFrame(FLAT, "k string, a string, b int, c string")
    tuples = star.key_tuples(flat, "k", ["k", "a", "b", "c"])
    states = summaries.key_states(tuples, "k")
    by_key = {r["k"]: r for r in states.collect()}
    assert by_key["k1"]["n_rows"] == 4 and tuple(by_key["k1"]["a"]) == ("x", "z") and tuple(by_key["k3"]["a"]) == (None, None)
    assert {r["column_name"]: r["conflicting_keys"] for r in summaries.conflict_counts(states, "t", "k").collect()} == {"a": 2, "b": 0, "c": 0}
    assert _rows(summaries.conflicts(states, tuples, "t", "k")) == sorted(
        [("t", "a", "k1", 3, "x", 2, "z", 1), ("t", "a", None, 2, "x", 1, "y", 1)], key=str)
    halves = [summaries.key_states(star.key_tuples(spark.createDataFrame(p, flat.schema), "k", flat.columns), "k") for p in (FLAT[::2], FLAT[1::2])]
    assert _rows(summaries.merge_key_states(halves[0].unionByName(halves[1]), "k")) == _rows(states)
    none = star.key_tuples(flat.filter("false"), "k", flat.columns)
    assert summaries.conflicts(summaries.key_states(none, "k"), none, "t", "k").count() == 0


def test_presence_is_exact(spark):
    rng = random.Random(3)
    keys = [-70_000, -32_768, -1, 0, 1, 32_768, 32_769, 2**40, None]
    rows = [(rng.choice(["a", "b", None]), rng.randrange(3), rng.choice(keys) if rng.random() < 0.2 else rng.randrange(-40_000, 90_000)) for _ in range(5_000)]
    rows += [("hot", 0, 7)] * 3_000 + [("empty", 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, k long")
    seen = summaries.presence(df, ["g", "h"], "k")
    for groups in (["g", "h"], ["g"], ["h"], []):
        want = {}
        for r in rows:
            if r[2] is not None:
                want.setdefault(tuple(r["gh".index(c)] for c in groups), set()).add(r[2])
        got = {tuple(r)[:-1]: r["n"] for r in summaries.distinct_counts(seen, groups, "n").collect()}
        assert got == {g: len(s) for g, s in want.items()}
    halves = [summaries.presence(spark.createDataFrame(p, df.schema), ["g", "h"], "k") for p in (rows[:2_500], rows[2_500:])]
    merged = summaries.merge_presence(halves[0].unionByName(halves[1]), ["g", "h"])
    assert _rows(summaries.distinct_counts(merged, ["g"], "n")) == _rows(summaries.distinct_counts(seen, ["g"], "n"))
    assert summaries.distinct_counts(summaries.presence(df.filter("false"), ["g"], "k"), ["g"], "n").count() == 0
    with pytest.raises(TypeError):
        summaries.presence(df, ["h"], "g")


def test_numbered_keys_are_distinct(spark):
    dim = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "k string").repartition(3)
    rows = summaries.numbered_keys(dim, "k").collect()
    assert {r["k"] for r in rows} == {"a", "b", "c"} and len({r["key_number"] for r in rows}) == 3


def test_stored_summaries_equal_scans(spark, sf_small):
    fact, flat = queries.fact(spark, sf_small), queries.observations(spark, sf_small)
    floating = [f.name for f in fact.schema.fields if f.dataType.typeName() in ("double", "float")]
    tables = {n: stage.table(spark, sf_small, n) for n in STAR_TABLE_ORDER}
    assert _rows(queries.q_row_counts(spark, sf_small)) == _rows(checks.row_counts(tables))
    assert _rows(queries.q_nonfinite_audit(spark, sf_small)) == _rows(checks.nonfinite_audit(fact, floating))
    assert _rows(queries.q_null_counts(spark, sf_small)) == _rows(checks.null_counts(queries.model_frame(spark, sf_small)))
    assert _rows(queries.q_observation_null_counts(spark, sf_small)) == _rows(checks.null_counts(flat))
    assert _rows(queries.q_fd_audit(spark, sf_small)) == _rows(star.fd_audit(flat))
    plain = reports.platform_comparison(fact, queries.dim_platform(spark, sf_small))
    assert _rows(queries.q_platform_comparison(spark, sf_small)) == _rows(plain)


def test_checks_read_no_fact_row(spark, sf_small):
    for query in (queries.q_row_counts, queries.q_nonfinite_audit, queries.q_null_counts, queries.q_observation_null_counts,
                  queries.q_fd_audit, queries.q_column_profile, queries.q_unique_games):
        files = query(spark, sf_small).inputFiles()
        assert files and all(any(f"/{s}/" in f for s in ("profile", "key_states", "games_seen")) for f in files), query.__name__


def test_unique_games_of_text_keys(spark, tmp_path, monkeypatch):
    fact = spark.createDataFrame([("g1", 1, "a"), ("g2", 1, "a"), ("g1", 1, "b"), ("g1", 2, "b"), (None, 2, "b")], "game_id string, platform_code int, launch_phase string")
    root = str(tmp_path / "t")
    fact.write.parquet(f"{root}/fact_weekly_metrics")
    fact.select("game_id").distinct().write.parquet(f"{root}/dim_games")
    stage._write_presence(spark, root)
    seen = spark.read.parquet(f"{root}/games_seen")
    assert {r[0]: r[1] for r in summaries.distinct_counts(seen, ["platform_code"], "n").collect()} == {1: 2, 2: 1}
