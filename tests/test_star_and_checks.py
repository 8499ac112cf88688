import os

import pytest

from tessera.operators import checks, features, reports, star
from tessera.sources import files


def test_dimension_any_value_skips_leading_null(spark):
    flat = spark.createDataFrame([(1, None, "a"), (1, "x", "a"), (2, "y", None)], "k long, name string, other string")
    got = {r["k"]: (r["name"], r["other"]) for r in star.dimension(flat, "k", ["k", "name", "other"]).collect()}
    assert got == {1: ("x", "a"), 2: ("y", None)}


def test_fd_audit_counts_conflicts(spark):
    flat = spark.createDataFrame(
        [(1, "n1", 10), (1, "n2", 10), (2, "n3", 11)],
        "game_id long, game_name string, publisher_avg_budget int",
    )
    rows = {(r["table_name"], r["column_name"]): r["conflicting_keys"] for r in star.fd_audit(flat).collect()}
    assert rows[("dim_games", "game_name")] == 1
    assert rows[("dim_games", "publisher_avg_budget")] == 0


def test_row_count_check_missing_table(spark):
    counts = checks.catalog_row_counts(spark, ["no_such_table_xyz"])
    out = checks.row_count_check(spark, counts, {"no_such_table_xyz": 1}).first()
    assert out["row_count"] is None and out["passed"] is False


def test_verification_report_flags_failure(spark):
    t = spark.range(3).withColumnRenamed("id", "x")
    _, passed = checks.verification_report(spark, {"dim_platform_like": t}, {"dim_platform_like": 5})
    assert passed is False
    _, passed = checks.verification_report(spark, {"dim_platform_like": t}, {"dim_platform_like": 3})
    assert passed is True


def test_drop_unknown_column_raises(spark):
    df = spark.range(1)
    with pytest.raises(KeyError):
        features.drop_columns(df, ["nope"])


def test_null_counts_nan_and_null(spark):
    df = spark.createDataFrame([(None, float("nan"), "a"), (1, 2.0, None)], "a int, b double, c string")
    got = {r["column_name"]: r["null_count"] for r in checks.null_counts(df).collect()}
    assert got == {"a": 1, "b": 1, "c": 1}


def test_label_encode_sorted_codes(spark):
    df = spark.createDataFrame([("b", 10), ("a", 2), ("b", 1)], "g string, p int")
    enc, mapping = features.label_encode(df, ["g", "p"])
    m = {(r["column_name"], r["label"]): r["code"] for r in mapping.collect()}
    assert m[("g", "a")] == 0 and m[("g", "b")] == 1
    # text order: "1" < "10" < "2"
    assert m[("p", "1")] == 0 and m[("p", "10")] == 1 and m[("p", "2")] == 2
    assert sorted(r["p"] for r in enc.collect()) == [0, 1, 2]


def test_lifecycle_ordered_sorts_unknown_last(spark):
    fact = spark.createDataFrame(
        [("long_tail", 1, 1.0, 0.1, 5.0), ("beta", 2, 2.0, 0.1, 5.0), ("launch_week", 3, 3.0, 0.1, 5.0),
         (None, 9, 9.0, 0.1, 5.0)],
        "launch_phase string, concurrent_players long, estimated_revenue_usd double, hype_score double, "
        "discount_pct double",
    )
    rows = reports.lifecycle_ordered(fact).collect()
    assert [r["launch_phase"] for r in rows] == ["launch_week", "long_tail", "beta"]


def test_csv_nonfinite_text(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("x,y\ninf,1\n-inf,2\nnan,3\n,4\n")
    df = files.read_csv(spark, str(p), "x double, y int")
    xs = [r["x"] for r in df.orderBy("y").collect()]
    assert xs[0] == float("inf") and xs[1] == float("-inf") and xs[2] != xs[2] and xs[3] is None


def test_csv_round_trip_keeps_values(spark, tmp_path):
    df = spark.createDataFrame([(1, float("inf"), "a"), (2, float("nan"), None), (3, 1.25e7, "c")],
                               "k int, v double, s string")
    out = str(tmp_path / "rt")
    files.write_csv(df, out)
    back = {r["k"]: r for r in files.read_csv(spark, out, df.schema).collect()}
    assert back[1]["v"] == float("inf") and back[2]["v"] != back[2]["v"] and back[3]["v"] == 1.25e7
    assert back[2]["s"] is None


def test_describe_and_width(spark):
    df = spark.createDataFrame([(1, "a", 1.0)], "a bigint, b string, c double")
    rows = files.describe(spark, df).collect()
    assert [(r["ordinal"], r["column_name"], r["column_type"]) for r in rows] == [
        (1, "a", "bigint"), (2, "b", "string"), (3, "c", "double")]
    assert files.width(spark, df).first()["n_columns"] == 3


def test_file_inventory_and_missing_path(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.txt").write_text("x")
    inv = files.file_inventory(spark, str(tmp_path), "*.csv").collect()
    assert [r["relative_path"] for r in inv] == ["sub/a.csv"]
    with pytest.raises(FileNotFoundError):
        files.require_path(spark, os.path.join(str(tmp_path), "missing"), "run the ingest first")
