import pytest
from pyspark.sql import functions as F

from tessera.operators import sampling
from tessera.sources import files


def _frame(spark, n=3000):
    return spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("obs_key"),
        (F.col("id") % 7 == 0).cast("int").alias("y"),
    )


def test_exact_sample_size_and_repeatability(spark):
    df = _frame(spark)
    a = {r["obs_key"] for r in sampling.exact_sample(df, 123, seed=42).collect()}
    b = {r["obs_key"] for r in sampling.exact_sample(df, 123, seed=42).collect()}
    c = {r["obs_key"] for r in sampling.exact_sample(df, 123, seed=7).collect()}
    assert len(a) == 123 and a == b and a != c


def test_exact_sample_larger_than_frame(spark):
    df = _frame(spark, 50)
    assert sampling.exact_sample(df, 500).count() == 50
    with pytest.raises(ValueError):
        sampling.exact_sample(df, 500, strict=True)


def test_stratified_split_quota_per_class(spark):
    df = _frame(spark)
    split = sampling.stratified_split(df, "y", test_size=0.2)
    counts = {(r["split"], r["y"]): r["n_rows"] for r in sampling.split_balance(split, "y").collect()}
    n1 = df.filter("y = 1").count()
    n0 = df.count() - n1
    assert counts[("test", 1)] + counts[("test", 0)] == 600  # ceil(0.2 * 3000)
    assert abs(counts[("test", 1)] - 0.2 * n1) < 1 and abs(counts[("test", 0)] - 0.2 * n0) < 1
    assert counts[("train", 1)] + counts[("test", 1)] == n1
    assert split.count() == df.count()


def test_sampled_csv_inference(spark, tmp_path):
    p = tmp_path / "obs.csv"
    p.write_text("k,v,d,s\n" + "".join(f"{i},{i / 3},2020-01-0{i % 9 + 1},x{i}\n" for i in range(200)) + "7,inf,2020-01-01,y\n")
    df = files.read_csv(spark, str(p), sampling_ratio=1.0)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types == {"k": "int", "v": "double", "d": "date", "s": "string"}
    assert df.filter(F.col("v") == float("inf")).count() == 1
