"""Corpus pipeline: each stage works on all rows that its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame.  ``run`` writes each stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, minhash, mixing, packing, queries
from tessera.llm.common import documents, id_crc, written

#: A document whose language is less likely than this, over its whole text, is rejected.
#: With four languages even odds are 0.25, so only texts that look like none of them fall below.
LEAST_LANGUAGE = 0.3

#: Here each document counts once at most.
RECIPE = replace(queries.RECIPE, max_epochs=1)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the texts in a known language (operator 3); ``lang`` becomes the predicted one.

    Rejected: null texts, texts without a letter, texts below :data:`LEAST_LANGUAGE`.  If no
    row carries a language there is nothing to learn, and every row is kept as it is.
    """
    net = langid.fit(docs.filter(id_crc() % 5 != 0).select("doc_id", "text", "lang"))
    if net is None:
        return docs
    told = langid.predict(docs, net, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")])
    kept = told.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE))
    return kept.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the least id of each near-duplicate class (operator 4).

    Classes are of rows, by their texts alone: rows of one id with different texts are not
    near-duplicates, equal rows are.  Among rows of one least id any one stays (equal texts) or
    the one that was numbered first; a row without an id stays if its class has no other, or
    none with an id.  Null and empty texts are one class.  An empty table stays empty; extra
    columns are kept, whatever their names.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), whole), "pipeline-rows")
    classes = minhash.near_duplicates(rows, id_col="row", text_col="doc.text").select(F.col("doc_id").alias("row"), "class_id")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    named = classes.join(rows.select("row", F.col("doc.doc_id").alias("id")).hint("merge"), "row")
    kept = written(named.groupBy("class_id").agg(least).select("first.row"), "pipeline-kept")
    # The kept rows grow with the corpus: the same shuffle join at any size.
    return rows.join(kept.hint("merge"), "row", "left_semi").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep each leaf's prefix that its budget reaches (operator 8), the last document whole.

    Rows of one id and leaf are taken or left together; null and empty texts hold no tokens;
    null sources and languages have leaves of their own; an empty table stays empty; extra
    columns are kept, whatever their names.
    """
    return mixing.mix(docs, RECIPE).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenised pieces in sequences (operator 1); a null or empty text is its end id alone,
    equal rows are packed one by one, an empty table gives no pieces."""
    return packing.pack(docs, queries.tokenizer_file())


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The classifier and the sampled signatures have no SQL form; tests/llm hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
