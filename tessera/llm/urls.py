"""URL filter: host and path rules, and gradient-boosted trees on lexical features.

Everything is DataFrame expressions and Spark's own tree learner; no Python runs on the
executors.  The labelled URLs are those that a rule decides (blocked: 1); the trees judge
the others by length, depth, digit ratio, character entropy, parameter counts and
statistics of the host's suffixes.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Distinct labelled URLs that the trees are trained on at most, the lowest seeded hashes first.
MAX_TRAINING_URLS = 20_000
#: Suffix statistics are broadcast up to this many rows (about 60 bytes each), joined by shuffle beyond.
BROADCAST_SUFFIXES = 200_000
#: Pseudo-counts that pull a rare suffix's rate to one half.
PRIOR = 10.0
TREES, DEPTH, STEP, SEED = 20, 4, 0.2, 23
#: Parts of the labelled urls; a training url's suffix statistics come from the other parts.
FOLDS = 5


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for a null url or one without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(name, verdict) of the longest rule that fits, a blocking one before an allowing one of equal length; else null."""
    found = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<name:string,verdict:string>")


def _entropy(text: Column) -> Column:
    """Bits per character of the text's own characters; 0 for an empty one."""
    n = F.length(text)
    counts = F.transform(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")), lambda c: (n - F.length(F.replace(text, c, F.lit("")))).cast("double"))
    total = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * F.log2(c))
    return F.when(n > 0, F.log2(n) - total / n).otherwise(F.lit(0.0))


def _count(text: Column, signs: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, signs, ""))).cast("double")


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The lexical features by name (suffix statistics aside)."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    size = F.greatest(F.length(url), F.lit(1))
    return {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "host_depth": F.size(F.split(host, r"\.")).cast("double"),
        "path_depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double"),
        "digit_ratio": _count(url, string.digits) / size,
        "host_digits": _count(host, string.digits),
        "hyphens": _count(host, "-"),
        "url_entropy": _entropy(url),
        "host_entropy": _entropy(host),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double"),
        "parameter_length": F.length(query).cast("double"),
        "escapes": _count(url, "%"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
    }


def _suffixes(host: Column) -> tuple[Column, Column]:
    """The host's last label, and its last two with a dot before them (so that the two kinds never meet)."""
    return F.substring_index(host, ".", -1), F.concat(F.lit("."), F.substring_index(host, ".", -2))


def labelled_urls(pages: DataFrame, rules: list[Rule], *, url_col: str = "url") -> DataFrame:
    """The distinct urls that a rule decides: url, host, path, label (1: blocked), weight (its rows)."""
    host, path = host_and_path(F.col("url"))
    base = pages.select(F.col(url_col).cast("string").alias("url")).withColumn("host", host).withColumn("path", path)
    fit = base.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)).filter("fit is not null")
    return fit.groupBy("url", "host", "path", (F.col("fit.verdict") == "block").cast("double").alias("label")).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def _rates(seen: Column, blocked: Column) -> list[Column]:
    return [F.log1p(seen).alias("seen"), ((blocked + PRIOR / 2) / (seen + PRIOR)).alias("rate")]


@dataclass
class Learned:
    """The trees, and the suffix statistics (suffix, seen, rate) over all labelled urls."""

    model: GBTClassificationModel
    suffixes: DataFrame
    small: bool

    def probability(self, urls: DataFrame) -> DataFrame:
        """``urls`` (url, host, path and others) with ``block_probability``."""
        table = F.broadcast(self.suffixes) if self.small else self.suffixes
        return self.model.transform(_assembled(urls, table, [])).withColumn("block_probability", vector_to_array("probability")[1])


def _assembled(urls: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """The vector of all features; suffix statistics by suffix and the columns ``on``."""
    lexical = features(F.col("url"), F.col("host"), F.col("path"))
    df = urls.withColumns(lexical)
    for name, key in zip(("last", "two"), _suffixes(F.col("host"))):
        renamed = table.select(*on, F.col("suffix").alias(f"{name}_key"), F.col("seen").alias(f"{name}_seen"), F.col("rate").alias(f"{name}_rate"))
        df = df.withColumn(f"{name}_key", key).join(renamed, [f"{name}_key", *on], "left")
        df = df.fillna({f"{name}_seen": 0.0, f"{name}_rate": 0.5})
    return VectorAssembler(inputCols=[*lexical, "last_seen", "last_rate", "two_seen", "two_rate"], outputCol="lexical").transform(df)


def learn(labelled: DataFrame, *, trees: int = TREES, max_training_urls: int = MAX_TRAINING_URLS) -> Learned | None:
    """Trees from labelled urls (a written table); None if they lack one of the two verdicts.

    A training url's suffix statistics are those of the other folds, so that no url's own label
    is among its features.  Statistics cover all labelled urls, the trees at most
    ``max_training_urls`` of them.
    """
    if labelled.select("label").distinct().count() < 2:
        return None
    fold = F.pmod(F.xxhash64("url", F.lit(SEED + 1)), F.lit(FOLDS)).alias("fold")
    by_fold = labelled.select("label", "weight", fold, F.explode(F.array(*_suffixes(F.col("host")))).alias("suffix")).groupBy("suffix", "fold").agg(
        F.sum("weight").alias("n"), F.sum(F.col("label") * F.col("weight")).alias("b"))
    by_fold = written(by_fold, "url-suffix-folds")
    totals = by_fold.groupBy("suffix").agg(F.sum("n").alias("n_all"), F.sum("b").alias("b_all"))
    suffixes = written(totals.select("suffix", *_rates(F.col("n_all"), F.col("b_all"))), "url-suffixes")
    others = by_fold.join(totals, "suffix").select("suffix", "fold", *_rates(F.col("n_all") - F.col("n"), F.col("b_all") - F.col("b")))
    train = labelled.orderBy(F.xxhash64("url", F.lit(SEED)), "url").limit(max_training_urls).withColumn("fold", fold)
    train = written(_assembled(train, others, ["fold"]).select("lexical", "label", "weight").coalesce(2), "url-train")
    learner = GBTClassifier(featuresCol="lexical", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=DEPTH, stepSize=STEP, seed=SEED)
    return Learned(learner.fit(train), suffixes, suffixes.count() <= BROADCAST_SUFFIXES)


@dataclass(frozen=True)
class Evaluation:
    """Held-out figures over distinct urls: ``base_accuracy`` is that of the commoner verdict."""

    n_urls: int
    accuracy: float
    base_accuracy: float
    auc: float


def evaluate(pages: DataFrame, rules: list[Rule], *, url_col: str = "url", trees: int = TREES) -> Evaluation | None:
    """How the trees judge a fifth of the urls that rules decide, learned from the others.

    Held out by a hash of the url.  None if a part lacks one of the two verdicts.
    """
    labelled = written(labelled_urls(pages, rules, url_col=url_col), "url-labelled")
    held = F.pmod(F.xxhash64("url", F.lit(SEED + 2)), F.lit(5)) == 0
    learned = learn(labelled.filter(~held), trees=trees)
    out = labelled.filter(held)
    if learned is None or out.select("label").distinct().count() < 2:
        return None
    scored = written(learned.probability(out).select("label", "block_probability"), "url-held-out")
    right = ((F.col("block_probability") >= 0.5).cast("double") == F.col("label")).cast("double")
    row = scored.agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("right"), F.avg("label").alias("blocked")).first()
    auc = BinaryClassificationEvaluator(rawPredictionCol="block_probability", labelCol="label").evaluate(scored)
    return Evaluation(row["n"], row["right"], max(row["blocked"], 1 - row["blocked"]), auc)


def judge(pages: DataFrame, rules: list[Rule], *, id_col: str = "page_id", url_col: str = "url", trees: int = TREES,
          max_training_urls: int = MAX_TRAINING_URLS) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_probability) for every row of ``pages``.

    ``rule``: the longest that fits, null if none; its verdict holds.  Other urls are blocked
    if the trees give 0.5 or more.  If the labelled urls lack one of the two verdicts there
    is nothing to learn: urls without a rule are then allowed, their probability null.

    Null urls and urls without `://` have an empty host and path and fit no rule; null ids
    stay; equal rows are judged alike; an empty table gives no rows.  Other columns of
    ``pages`` play no part.
    """
    host, path = host_and_path(F.col("url"))
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    base = base.withColumn("host", host).withColumn("path", path).withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    learned = learn(written(labelled_urls(pages, rules, url_col=url_col), "url-labelled"), trees=trees, max_training_urls=max_training_urls)
    out = base.withColumn("block_probability", F.lit(None).cast("double")) if learned is None else learned.probability(base)
    guess = F.when(F.col("block_probability") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("fit.name").alias("rule"), F.coalesce(F.col("fit.verdict"), guess).alias("verdict"), "block_probability")
