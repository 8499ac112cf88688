"""The pipeline's stages, the queries' SQL and the registration."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline  # noqa: E402
from oracle_compare import compare  # noqa: E402

from tessera.llm import minhash, queries  # noqa: E402

from .test_operators import _check_packing, _classes  # noqa: E402


def test_stages_keep_the_documents_columns(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").withColumn("score", F.lit(1))
    extra = spark.createDataFrame([(90_001, None, "en", "src0", 0, 1), (90_002, "12 34 !!", None, "src0", 8, 1), (None, "the and of with that was for", "en", "src1", 28, 1)], docs.schema)
    docs = docs.unionAll(extra)
    (_, language), (_, dups), (_, mixing), (_, packing) = corpus_pipeline.STAGES
    one = language(spark, docs, sf_small)
    assert one.columns == docs.columns
    kept = {r["doc_id"] for r in one.collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {90_001, 90_002}
    two = dups(spark, docs.unionAll(docs.filter("doc_id = 7")), sf_small)
    assert two.columns == docs.columns
    left = sorted((r["doc_id"] for r in two.collect()), key=str)
    assert len(left) == len(set(left)) and None in left
    want = {r["doc_id"] for r in minhash.near_duplicates(docs.filter("text is not null")).filter("kept").collect()}
    assert want - {None} <= set(left) | {90_001}
    three = mixing(spark, docs, sf_small)
    assert three.columns == docs.columns and 0 < three.count() < docs.count()
    assert packing(spark, docs.filter("false"), sf_small).count() == 0


def test_stages_against_brute_force(spark, sf_small):
    import duckdb

    (_, language), (_, dups), (_, mixing), (_, pack) = corpus_pipeline.STAGES
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    one = language(spark, docs, sf_small).cache()
    before, after = ({r["doc_id"]: r for r in df.collect()} for df in (docs, one))
    assert set(after) == {i for i, r in before.items() if any(c.isalpha() for c in r["text"] or "")}
    told = [(r["lang"], before[i]["lang"]) for i, r in after.items() if before[i]["lang"]]
    assert sum(a == b for a, b in told) >= 0.97 * len(told)
    rows = [(r["doc_id"], r["text"]) for r in after.values()]
    weights = minhash.Weights(*minhash.frequent_shingles(one.select("text"), len(rows)), len(rows))
    two = dups(spark, one, sf_small).cache()
    left = {r["doc_id"]: r for r in two.collect()}
    assert sorted(left) == sorted(set(_classes(rows, weights).values())) and len(left) < len(after)
    con = duckdb.connect()
    con.register("documents", two.toPandas())
    sql = queries.ORACLE_SQL["op8_mixing"].replace("2 * sum(tokens)", "1 * sum(tokens)")  # one epoch at most
    three = mixing(spark, two, sf_small).cache()
    mixed = {r["doc_id"]: r for r in three.collect()}
    assert sorted(mixed) == sorted({r[0] for r in con.execute(f"SELECT doc_id FROM ({sql})").fetchall()})
    assert all(mixed[i] == left[i] for i in mixed)
    _check_packing(pack(spark, three, sf_small), [(r["doc_id"], r["text"]) for r in mixed.values()])


def test_run(spark, sf_small):
    out = corpus_pipeline.run(spark, sf_small)
    ids = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert ids and ids <= {r["doc_id"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, sf_small, name):
    same, said = compare(spark, sf_small, name, queries.QUERIES[name], queries.ORACLE_SQL[name])
    assert same, said


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13


def test_weights_of_zero(spark, sf_small):
    """Nodes of weight 0 get nothing; their siblings get what the plain recipe's SQL gives them without those rows."""
    import duckdb
    from dataclasses import replace

    from tessera.llm import mixing

    recipe = replace(queries.RECIPE, domains=queries.RECIPE.domains | {"books": (0, queries.RECIPE.domains["books"][1])}, languages=queries.RECIPE.languages | {"de": 0}, sources={"src3": 0})
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = sorted((r["row"]["doc_id"], r["mix_epoch"], r["mix_taken"]) for r in mixing.mix(docs, recipe).collect())
    sql = queries.ORACLE_SQL["op8_mixing"].replace("FROM rows GROUP BY ALL HAVING", "FROM rows WHERE domain <> 'books' AND lang <> 'de' AND source <> 'src3' GROUP BY ALL HAVING")
    sql = sql.replace("(SELECT sum(tokens) FROM leaves)", "(SELECT sum(tokens) FROM rows)")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert got and got == sorted(con.execute(f"SELECT doc_id, epoch, taken FROM ({sql})").fetchall())
    nothing = replace(queries.RECIPE, domains={k: (0, v) for k, (_, v) in queries.RECIPE.domains.items()}, other_domain=0)
    assert mixing.mix(docs.filter("text is not null and text <> ''"), nothing).count() == 0
    with pytest.raises(ValueError):
        replace(recipe, other_source=-1)


def test_rows_of_one_id(spark):
    (_, dups) = corpus_pipeline.STAGES[1]
    a, b = "alpha beta gamma delta epsilon zeta eta theta", "completely different words stand in this one here now"
    rows = [(1, a, "x"), (1, b, "x"), (1, a, "y"), (2, a, "x"), (3, b, "z"), (None, a, "x"), (None, "words of a row without any id at all", "x"), (None, None, "n"), (7, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").withColumns({c: F.lit("k") for c in ("doc", "class_id", "id", "none", "first")}).repartition(3)
    got = dups(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in got.collect() if r["doc_id"]) == [(1, a), (1, b), (7, "")]
    assert [r["text"] for r in got.filter("doc_id is null").collect()] == [rows[6][1]]
    assert dups(spark, docs.filter("false"), "").count() == 0
