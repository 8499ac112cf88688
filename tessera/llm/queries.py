"""The registered queries of this subpackage: each applies its operator, with production
parameters, to its whole table and derives the digest columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import best_two_fit, chat, langid, license, lm, minhash, mixing, packing, rabitq, spelling, trie, urls, winnowing
from .common import documents, id_crc, written
from .oracle import ORACLE_SQL as ORACLE_SQL


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    packed = packing.pack(documents(spark, sf_dir), tokenizer_file())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "sequence_length")


#: Twenty sources in four domains; other sources, languages and null ones get the recipe's other weights.
RECIPE = mixing.Recipe(
    domains={
        "web": (50, tuple(f"src{i}" for i in range(0, 5))),
        "news": (20, tuple(f"src{i}" for i in range(5, 10))),
        "books": (20, tuple(f"src{i}" for i in range(10, 15))),
        "reference": (10, tuple(f"src{i}" for i in range(15, 20))),
    },
    languages={"en": 40, "de": 20, "fr": 20, "es": 20},
)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, epoch) that the recipe chooses, three quarters of all words together."""
    chosen = mixing.mix(documents(spark, sf_dir), RECIPE)
    return chosen.select("row.doc_id", F.col("mix_domain").alias("domain"), F.col("mix_lang").alias("lang"), F.col("mix_source").alias("source"),
                         F.col("mix_epoch").alias("epoch"), F.col("mix_tokens").alias("tokens"), F.col("mix_taken").alias("taken"))


URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op2_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families found in every whole text, with the places and the surest probability."""
    docs = documents(spark, sf_dir)
    found = license.scan(docs, license.train(license.sample_lines(docs)))
    return found.select("doc_id", "n_paragraphs", F.array_join(F.array_sort(F.array_distinct("found.family")), ",").alias("families"),
                        F.size("found").cast("long").alias("n_found"), F.array_max("found.probability").alias("probability"), F.to_json("found").alias("places"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text; learned from the rows that are not held out."""
    docs = documents(spark, sf_dir)
    held_out = (id_crc() % 5 == 0).alias("held_out")
    net = langid.fit(docs.filter(id_crc() % 5 != 0).select("doc_id", "text", "lang"))
    return langid.predict(docs, net, [F.col("doc_id"), held_out])


def op4_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return minhash.near_duplicates(documents(spark, sf_dir))


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how near both and the next document are."""
    return winnowing.edits(documents(spark, sf_dir))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every whole text; learned from the rows that are not held out."""
    scored = lm.score(documents(spark, sf_dir), id_crc() % 10 != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of one whose texts hold control strings, read back from the formatted text."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    marks = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_chats(turns.unionByName(extra)), ordered=True)


def op10_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return rabitq.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, each of which begins with up to three turns of its group's first one."""
    seqs = written(trie.sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "trie-conversations")
    return trie.prefix_trie(trie.borrow_heads(seqs, F.expr("conv_id - conv_id % 20"), id_crc("conv_id") % 4, 3))


def bytes_tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op12_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids, as few as the rule finds."""
    packed = best_two_fit.pack(documents(spark, sf_dir), bytes_tokenizer_file())
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forms of all words of all documents, with a typing error planted in every 97th one by hash."""
    return spelling.variants(spelling.vocabulary(documents(spark, sf_dir), delete_every=97))


QUERIES = {q.__name__: q for q in (op1_packing, op2_license, op3_language, op4_near_dups, op5_winnowing, op6_lm_scores, op7_chat_format, op8_mixing,
                                   op9_url_filter, op10_embedding_dups, op11_prefix_trie, op12_best_two_fit, op13_spelling)}
