import math

from pyspark.sql import functions as F

from tessera.functions.categorical import as_label_text, discount_bucket, phase_rank
from tessera.functions.numeric import finite_or_null, growth_rate, round_half_up, round_plain


def test_rounding_ties_half_up(spark):
    df = spark.createDataFrame([(0.285,), (1.005,), (2.5,), (-2.5,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2).alias("a")).collect()]
    assert got == [0.29, 1.01, 2.5, -2.5]
    got0 = [r[0] for r in df.select(round_half_up("x", 0)).collect()]
    assert got0[2:] == [3.0, -3.0]


def test_plain_round_keeps_nonfinite(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),)], "x double")
    a, b = [r[0] for r in df.select(round_plain("x", 4)).collect()]
    assert a == float("inf") and math.isnan(b)


def test_discount_bucket_edges(spark):
    vals = [0.0, 0.01, 9.99, 10.0, 24.99, 25.0, 49.99, 50.0, 74.99, 75.0, -3.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = [r[0] for r in df.select(discount_bucket("d")).collect()]
    assert got == [
        "0% (no discount)", "1-9%", "1-9%", "10-24%", "10-24%", "25-49%", "25-49%", "50-74%", "50-74%",
        "75%+", "75%+", "75%+",
    ]


def test_phase_rank_unknown_sorts_last(spark):
    df = spark.createDataFrame([("long_tail",), ("beta",), ("launch_week",), (None,)], "p string")
    rows = df.select("p", phase_rank("p").alias("r")).orderBy(F.asc_nulls_last("r")).collect()
    assert [r["p"] for r in rows][:2] == ["launch_week", "long_tail"]
    assert rows[2]["r"] is None and rows[3]["r"] is None


def test_growth_rate_zero_base(spark):
    df = spark.createDataFrame([(5, 0), (0, 0), (3, None), (6, 3)], "cur long, prev long")
    got = [r[0] for r in df.select(growth_rate(F.col("cur"), F.col("prev"))).collect()]
    assert got[0] == float("inf") and math.isnan(got[1]) and got[2] is None and got[3] == 1.0


def test_finite_mean_and_raw_mean(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.0,)], "x double")
    row = df.agg(F.avg(finite_or_null("x")).alias("clean"), F.avg("x").alias("raw")).first()
    assert row["clean"] == 1.0 and math.isnan(row["raw"])
    df2 = spark.createDataFrame([(float("inf"),), (1.0,)], "x double")
    assert df2.agg(round_plain(F.avg("x"), 4)).first()[0] == float("inf")


def test_label_text_of_missing(spark):
    df = spark.createDataFrame([(None,), (3,)], "x int")
    assert [r[0] for r in df.select(as_label_text("x")).collect()] == ["nan", "3"]
