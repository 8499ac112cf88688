import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import metrics, ordered


def _values(spark, n=20_000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 else f"g{i % 5}"
        v = rnd.choice([5.0, 5.0, 5.0, rnd.random() * 100, float(rnd.randint(0, 20))])
        rows.append((g, v if i % 97 else None))
    return spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("final_rows", [250_000, 500])
def test_exact_median_matches_builtin(spark, monkeypatch, final_rows):
    monkeypatch.setattr(ordered, "FINAL_ROWS", final_rows)
    df = _values(spark)
    got = {r["g"]: r["m"] for r in ordered.exact_median(df, ["g"], "v", alias="m").collect()}
    want = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12), k


def test_exact_median_global_and_even_count(spark, monkeypatch):
    monkeypatch.setattr(ordered, "FINAL_ROWS", 3)
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100, 7, 7, 7]], "v double")
    assert ordered.exact_median(df, [], "v", alias="m").first()["m"] == 5.5


def _brute_rank(df, key, strata, quota):
    w = Window.partitionBy(*strata).orderBy(key) if strata else Window.orderBy(key)
    return df.withColumn("_rn", F.row_number().over(w))


@pytest.mark.parametrize("per_bucket", [50_000, 40])
def test_hash_rank_flag_matches_row_number(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(ordered, "ROWS_PER_HASH_BUCKET", per_bucket)
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"), (F.col("id") % 3).alias("c"))
    quota = spark.createDataFrame([(0, 100), (1, 0), (2, 99999)], "c long, _quota long")
    got = {r["k"] for r in ordered.hash_rank_flag(df, "k", ["c"], quota, "sel").filter("sel").collect()}
    ranked = _brute_rank(df, "k", ["c"], quota).join(quota, "c")
    want = {r["k"] for r in ranked.filter(F.col("_rn") <= F.col("_quota")).collect()}
    assert got == want
    assert len(got) == 100 + 0 + df.filter("c = 2").count()
    total = ordered.hash_rank_flag(df, "k", ["c"], quota, "sel").count()
    assert total == 5000


def _brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    acc = 0.0
    for p in pos:
        for q in neg:
            acc += 1.0 if p > q else 0.5 if p == q else 0.0
    return acc / (len(pos) * len(neg))


def test_roc_auc_cases(spark):
    rnd = random.Random(3)
    rows = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(600)]
    df = spark.createDataFrame(rows, "s double, y int")
    want = _brute_auc(rows)
    for levels in (None, 0, 1, 2):
        assert metrics.roc_auc(df, "y", "s", levels=levels).first()[0] == pytest.approx(want, rel=1e-12), levels
    same = spark.createDataFrame([(0.3, 0), (0.3, 1), (0.3, 1)], "s double, y int")
    assert metrics.roc_auc(same, "y", "s").first()[0] == 0.5
    perfect = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.9, 1)], "s double, y int")
    assert metrics.roc_auc(perfect, "y", "s").first()[0] == 1.0
    one = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert metrics.roc_auc(one, "y", "s").first()[0] is None


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "y int, p int")
    rows = {r["label"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert rows["Breakout Hit"]["precision"] == 0.0
    assert rows["Breakout Hit"]["recall"] == 0.0
    assert rows["accuracy"]["f1_score"] == pytest.approx(2 / 3, abs=1e-4)
    assert rows["Not Breakout"]["support"] == 2


def _fact_scans(spark, df, run):
    """How often the input's rows are counted by an accumulator while ``run`` runs."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    run(df.mapInArrow(count, df.schema))
    return seen.value / df.count()


@pytest.mark.parametrize("groups", [["g"], []])
def test_median_scans_its_input_twice(spark, monkeypatch, groups):
    monkeypatch.setattr(ordered, "FINAL_ROWS", 20)  # many narrowing levels
    df = _values(spark, n=30_000).cache()
    assert _fact_scans(spark, df, lambda d: ordered.exact_median(d, groups, "v").collect()) == 2


@pytest.mark.parametrize("final_rows", [250_000, 4])
@pytest.mark.parametrize("kind", ["distinct", "hot", "odd", "halves"])
def test_median_brackets(spark, monkeypatch, final_rows, kind):
    monkeypatch.setattr(ordered, "FINAL_ROWS", final_rows)
    rnd = random.Random(5)
    inf, nan = float("inf"), float("nan")
    draw = {"distinct": rnd.random, "hot": lambda: 3.0 if rnd.random() < 0.6 else rnd.random() * 9, "odd": lambda: rnd.choice([inf, -inf, nan, 0.0, -0.0, 1.0, None]),
            "halves": lambda: rnd.choice([1.0, 2.0])}[kind]
    df = spark.createDataFrame([(rnd.choice(["a", "a", "b", None, "c"]), draw()) for _ in range(9_001)] + [("one", 4.0), ("none", None)], "g string, v double").repartition(5)
    got = {r["g"]: repr(r["m"]) for r in ordered.exact_median(df, ["g"], "v", "m").collect()}
    want = {}
    for g in (None, "a", "b", "c", "one"):
        values = sorted((r["v"] for r in df.filter(F.col("g").eqNullSafe(g) & F.col("v").isNotNull()).collect()), key=lambda x: (x != x, x))
        lo, hi = values[(len(values) - 1) // 2], values[len(values) // 2]
        want[g] = repr(lo + 0.0 if lo == hi or lo != lo and hi != hi else lo + (hi - lo) * 0.5)
    assert got == {g: v.replace("-0.0", "0.0") if v == "-0.0" else v for g, v in want.items()}


def test_median_outside_its_bracket(spark, monkeypatch):
    """A bracket that misses is widened."""
    monkeypatch.setattr(ordered, "BRACKET_SHARE", -0.02)
    df = _values(spark, n=3_000)
    got = {r["g"]: r["m"] for r in ordered.exact_median(df, ["g"], "v", alias="m").collect()}
    assert got == pytest.approx({r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()})


def _scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_hash_rank_flag_reads_whole_rows_once(spark, tmp_path):
    spark.range(4000).selectExpr("md5(cast(id as string)) as k", "cast(id % 3 as int) as c", "id as other").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    split = ordered.hash_rank_flag(df, "k", ["c"], spark.createDataFrame([(0, 100), (1, 0), (2, 9999)], "c int, _quota bigint"), "sel")
    sample = ordered.hash_rank_flag(df, "k", [], spark.createDataFrame([(700,)], "_quota bigint"), "sel")
    assert _scans(split) == 1 and _scans(sample) == 1
    assert {r["c"]: r["n"] for r in split.filter("sel").groupBy("c").agg(F.count("k").alias("n")).collect()} == {0: 100, 2: 1333}
    assert split.count() == sample.count() == 4000
    assert {r["k"] for r in sample.filter("sel").collect()} == {r["k"] for r in df.orderBy("k").limit(700).collect()}


def test_hash_rank_flag_parts_rows_of_one_key(spark):
    """A quota that ends within the rows of one key takes as many of them as are left, in every stratum."""
    df = spark.range(60).selectExpr("md5(cast(id % 6 as string)) as k", "cast(id % 2 as int) as c", "id")
    keys = sorted({r["k"] for r in df.filter("c = 0").collect()})
    got = ordered.hash_rank_flag(df, "k", ["c"], spark.createDataFrame([(0, 13), (1, 20)], "c int, _quota bigint"), "sel")
    held = {(r["c"], r["k"]): r["n"] for r in got.filter("sel").groupBy("c", "k").agg(F.count("id").alias("n")).collect()}
    assert got.count() == 60
    assert [held.get((0, k), 0) for k in keys] == [10, 3, 0] and sum(n for (c, _), n in held.items() if c == 1) == 20
    everywhere = ordered.hash_rank_flag(df, "k", [], spark.createDataFrame([(25,)], "_quota bigint"), "sel")
    assert everywhere.filter("sel").count() == 25 and everywhere.count() == 60
    assert ordered.hash_rank_flag(df.limit(0), "k", [], spark.createDataFrame([(25,)], "_quota bigint"), "sel").count() == 0
