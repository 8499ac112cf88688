"""Mixing sources to target weights: hierarchical token budgets and seeded token prefixes.

Weights run down a tree domain > language > source.  A node can give at most what its
sources hold, times the epochs allowed.  Each parent's budget goes to its children by
weight, each up to what it can give; what a child cannot use goes to its siblings first,
and only what a whole node cannot use reaches the node's own siblings.  All arithmetic is
in whole tokens, so equal inputs give equal budgets on any engine.

Every leaf then reads its documents in epochs, each in a seeded order of its own: whole
epochs first, then the shortest prefix that reaches the budget.  The prefix's last key is
found by token sums over key prefixes, a few digits at a time, so no leaf is sorted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: A word: bytes other than space and \x09-\x0D.  Documents are measured in words.
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the seeded order key, and how many of them one pass resolves.
KEY_DIGITS, PASS_DIGITS = 15, 3
#: Rows of a key prefix that a window may order at the last step.
LAST_ROWS = 4096
#: Leaves up to which the budget table is broadcast (about 100 bytes each); a shuffle join beyond.
BROADCAST_LEAVES = 100_000

TREE = ["mix_domain", "mix_lang", "mix_source"]


@dataclass(frozen=True)
class Recipe:
    """Target weights (whole numbers; 0 leaves a node out).  ``domains``: name -> (weight, its sources)."""

    domains: dict[str, tuple[int, tuple[str, ...]]]
    languages: dict[str, int]
    sources: dict[str, int] = field(default_factory=dict)
    other_domain: int = 5
    other_language: int = 5
    other_source: int = 10
    #: Part of all tokens to take: numerator, denominator.
    budget: tuple[int, int] = (3, 4)
    max_epochs: int = 2
    seed: int = 17

    def __post_init__(self) -> None:
        weights = [*(w for w, _ in self.domains.values()), *self.languages.values(), *self.sources.values(), self.other_domain, self.other_language, self.other_source]
        if any(w < 0 for w in weights):
            raise ValueError("weights are 0 or more")

    def domain(self, source: Column) -> Column:
        found = F.lit("other")
        for name, (_, sources) in self.domains.items():
            found = F.when(source.isin(*sources), F.lit(name)).otherwise(found)
        return found

    @staticmethod
    def weight(key: Column, table: dict[str, int], other: int) -> Column:
        found = F.lit(other).cast("long")
        for name, w in table.items():
            found = F.when(key == name, F.lit(w).cast("long")).otherwise(found)
        return found


def _share(nodes: DataFrame, parent: list[str], name: str, give: str, budget: Column) -> DataFrame:
    """``nodes`` with a column ``give``: the parent's ``budget`` by ``weight``, each at most ``cap``."""
    # A node of weight 0 has no capacity: it comes first, is full with nothing and takes nothing.
    order = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(-1.0)).asc()
    before = Window.partitionBy(*parent).orderBy(order, F.col(name).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*parent).orderBy(order, F.col(name).asc_nulls_first()).rowsBetween(0, Window.unboundedFollowing)
    group = Window.partitionBy(*parent)
    return (
        nodes.withColumn("b", budget)
        .withColumn("left", F.col("b") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(after))
        .withColumn("full", F.col("cap") * F.col("rest") <= F.col("weight") * F.col("left"))
        .withColumn("over", F.col("b") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0)))
        .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(group))
        .withColumn(give, F.when(F.col("full"), F.col("cap")).otherwise(F.expr("(weight * over) div open")))
        .drop("b", "left", "rest", "full", "over", "open")
    )


def budgets(leaves: DataFrame, recipe: Recipe) -> DataFrame:
    """(tree columns, tokens, epochs: whole ones, rest: tokens of the next one) per leaf.

    ``leaves``: tree columns and ``tokens``.  A leaf without tokens gets nothing.  Nor does one
    below a node of weight 0: it has no capacity, and what its weight would have brought goes to
    its siblings, then to its ancestors' siblings.
    """
    level0 = Window.partitionBy()
    domain_weight = recipe.weight(F.col("mix_domain"), {k: w for k, (w, _) in recipe.domains.items()}, recipe.other_domain)
    lang_weight = recipe.weight(F.col("mix_lang"), recipe.languages, recipe.other_language)
    source_weight = recipe.weight(F.col("mix_source"), recipe.sources, recipe.other_source)
    taken = (domain_weight > 0) & (lang_weight > 0) & (source_weight > 0)
    leaves = leaves.filter("tokens > 0").withColumn("cap", F.when(taken, F.col("tokens") * recipe.max_epochs).otherwise(F.lit(0)))
    d = leaves.groupBy("mix_domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("held"))
    d = d.withColumn("weight", domain_weight)
    d = d.withColumn("all", F.sum("held").over(level0))
    d = _share(d, [], "mix_domain", "domain_give", F.expr(f"(all * {recipe.budget[0]}) div {recipe.budget[1]}"))
    n = leaves.groupBy("mix_domain", "mix_lang").agg(F.sum("cap").alias("cap"))
    n = n.withColumn("weight", lang_weight)
    n = _share(n.join(d.select("mix_domain", "domain_give"), "mix_domain"), ["mix_domain"], "mix_lang", "lang_give", F.col("domain_give"))
    s = leaves.withColumn("weight", source_weight)
    s = _share(s.join(n.select("mix_domain", "mix_lang", "lang_give"), ["mix_domain", "mix_lang"]), ["mix_domain", "mix_lang"], "mix_source", "give", F.col("lang_give"))
    return s.select(*TREE, "tokens", F.expr("cast(give div tokens as int)").alias("epochs"), F.expr("give % tokens").alias("rest"))


def _tree(docs: DataFrame, recipe: Recipe, source_col: str, lang_col: str, text_col: str, id_col: str) -> DataFrame:
    """The tree columns (a null language is `und`, a null source `none`), size and id of each row, and its own columns as `row`."""
    source = F.coalesce(F.col(source_col).cast("string"), F.lit("none"))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        recipe.domain(source).alias("mix_domain"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("mix_lang"),
        source.alias("mix_source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)).cast("long"), F.lit(0)).alias("mix_tokens"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("mix_id"),
    )


def _key(recipe: Recipe) -> Column:
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(recipe.seed)), (F.col("epochs") + 1).cast("string"), F.col("mix_id"))), 1, KEY_DIGITS)


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_LEAVES else table


def _cutoffs(rows: DataFrame, leaves: DataFrame, most_rows: int) -> DataFrame:
    """(tree columns, last, last_start): the key of the prefix's last document and the tokens before it.

    ``rows``: tree columns, mix_key, mix_tokens of leaves with a rest; ``leaves``: their rest.
    """
    by_leaf = Window.partitionBy(*TREE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    found = leaves.select(*TREE, "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("base"))
    digits, left = 0, most_rows
    while True:
        last = left <= LAST_ROWS or digits + PASS_DIGITS >= KEY_DIGITS
        digits = KEY_DIGITS if last else digits + PASS_DIGITS
        sums = (
            rows.join(_small(found), TREE).filter(F.col("mix_key").startswith(F.col("prefix")))
            .groupBy(*TREE, "rest", "base", F.substring("mix_key", 1, digits).alias("bucket"))
            .agg(F.sum("mix_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
            .withColumn("start", F.col("base") + F.coalesce(F.sum("tokens").over(by_leaf), F.lit(0)))
            .filter((F.col("start") < F.col("rest")) & (F.col("tokens") > 0))
        )
        at = sums.groupBy(*TREE, "rest").agg(F.max_by(F.struct("bucket", "start", "rows"), "bucket").alias("at"))
        found = written(at.select(*TREE, "rest", F.col("at.bucket").alias("prefix"), F.col("at.start").alias("base"), F.col("at.rows").alias("rows")), "mix-cut")
        if last:
            return found.select(*TREE, F.col("prefix").alias("last"), F.col("base").alias("last_start"))
        left = found.agg(F.max("rows")).first()[0] or 0
        found = found.drop("rows")


def mix(docs: DataFrame, recipe: Recipe, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        source_col: str = "source") -> DataFrame:
    """Every chosen (document, epoch): ``row`` (a struct of the document's own columns), the
    tree columns, ``mix_epoch`` from 1, ``mix_tokens`` (its words) and ``mix_taken``: the
    words of it that count, fewer than all only for the document that reaches the budget.

    Null language: `und`; null source: `none`; unlisted ones get the recipe's other weights.
    Null and empty texts hold no tokens and are chosen with a whole epoch or a prefix that
    passes them.  Rows of one id and leaf share a place in the order: they are taken or left
    together.  An empty table gives no rows.  Own columns cannot clash: they are in ``row``.
    """
    tree = _tree(docs, recipe, source_col, lang_col, text_col, id_col)
    narrow = written(tree.drop("row"), "mix-rows")
    plan = written(budgets(narrow.groupBy(*TREE).agg(F.sum("mix_tokens").alias("tokens")), recipe), "mix-plan")
    open_ = plan.filter("rest > 0")
    keyed = narrow.join(_small(open_), TREE).withColumn("mix_key", _key(recipe)).select(*TREE, "mix_key", "mix_tokens")
    most = narrow.groupBy(*TREE).count().agg(F.max("count")).first()[0] or 0
    cut = written(plan.join(_cutoffs(keyed, open_, most), TREE, "left"), "mix-budget")
    rows = tree.join(_small(cut), TREE)
    taken = F.when(F.col("mix_key") == F.col("last"), F.least("mix_tokens", F.col("rest") - F.col("last_start"))).otherwise(F.col("mix_tokens"))
    rows = rows.withColumn("mix_key", _key(recipe)).withColumn("in", F.coalesce(F.col("mix_key") <= F.col("last"), F.lit(False)))
    rows = rows.withColumn("times", F.col("epochs") + F.col("in").cast("int")).filter("times > 0")
    rows = rows.withColumn("mix_epoch", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return rows.select("row", *TREE, "mix_epoch", "mix_tokens",
                       F.when(F.col("mix_epoch") > F.col("epochs"), taken).otherwise(F.col("mix_tokens")).alias("mix_taken"))
