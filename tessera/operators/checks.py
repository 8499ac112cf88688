"""Verification and data-quality checks; each returns a small DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.numeric import POS_INF, NEG_INF, round_half_up
from tessera.schema import EXPECTED_MIN_ROWS


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for the given tables, one COUNT(*) each."""
    parts = [
        df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def row_count_check(spark: SparkSession, counts: DataFrame, minimums: dict[str, int] | None = None) -> DataFrame:
    """(table_name, row_count, minimum, passed) per expected table.

    A table missing from ``counts`` gives a row with NULL count and passed = false;
    nothing is raised (a failed check is a result, not an error).
    """
    minimums = minimums or EXPECTED_MIN_ROWS
    expected = spark.createDataFrame(list(minimums.items()), "table_name string, minimum bigint")
    return (
        expected.join(F.broadcast(counts), "table_name", "left")
        .select(
            "table_name",
            "row_count",
            "minimum",
            F.coalesce(F.col("row_count") >= F.col("minimum"), F.lit(False)).alias("passed"),
        )
    )


def catalog_row_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """Row counts of catalog tables by name; a missing table yields a NULL count."""
    schema = "table_name string, row_count bigint"
    parts = []
    for name in names:
        if spark.catalog.tableExists(name):
            parts.append(spark.table(name).agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
                         .select(F.lit(name).alias("table_name"), "row_count"))
        else:
            parts.append(spark.createDataFrame([(name, None)], schema))
    return reduce(DataFrame.unionByName, parts)


def platform_list(platform: DataFrame) -> DataFrame:
    return platform.select("platform_code", "platform", "storefront").orderBy(F.asc_nulls_last("platform"))


def sample_games(games: DataFrame, n: int = 5) -> DataFrame:
    """A few dimension rows for a spot check (first ``n`` by key, so repeatable).

    ``developer`` is shown where the source has it (the recast has none); the other columns
    must be there."""
    names = ["game_name", *[c for c in ("developer",) if c in games.columns], "genre"]
    flags = [F.col(c).cast("int").alias(c) for c in ("is_indie", "is_aaa", "release_year")]
    return games.orderBy("game_id").select(*names, *flags).limit(n)


def revenue_sanity(fact: DataFrame) -> DataFrame:
    """One row: mean and max weekly revenue, mean price, mean players."""
    return fact.agg(
        round_half_up(F.avg("estimated_revenue_usd"), 2).alias("avg_revenue"),
        round_half_up(F.max("estimated_revenue_usd"), 2).alias("max_revenue"),
        round_half_up(F.avg("current_price_usd"), 2).alias("avg_price"),
        round_half_up(F.avg("concurrent_players"), 0).alias("avg_players"),
    )


def verification_report(spark: SparkSession, tables: dict[str, DataFrame],
                        minimums: dict[str, int] | None = None) -> tuple[dict[str, DataFrame], bool]:
    """The whole verification step: named result frames and an overall pass flag.

    ``tables`` maps star-table names to DataFrames; missing names fail the count check.
    """
    counts = row_counts(tables)
    check = row_count_check(spark, counts, minimums)
    passed = check.filter(~F.col("passed")).limit(1).count() == 0
    out = {"row_count_check": check}
    if "dim_platform" in tables:
        out["platforms"] = platform_list(tables["dim_platform"])
    if "dim_games" in tables:
        out["sample_games"] = sample_games(tables["dim_games"])
    if "fact_weekly_metrics" in tables:
        out["revenue_sanity"] = revenue_sanity(tables["fact_weekly_metrics"])
    return out, passed


def report_rows(report: dict[str, DataFrame]) -> DataFrame:
    """The frames of :func:`verification_report` as one: (section, item, detail, value)."""
    def part(section: str, frame: DataFrame, item: F.Column, detail: F.Column, value: F.Column) -> DataFrame:
        return frame.select(F.lit(section).alias("section"), item.cast("string").alias("item"),
                            detail.cast("string").alias("detail"), value.cast("double").alias("value"))

    found = []
    if "row_count_check" in report:
        passed = F.when(F.col("passed"), "passed").otherwise("failed")
        found.append(part("row_count_check", report["row_count_check"], F.col("table_name"), passed, F.col("row_count")))
    if "platforms" in report:
        found.append(part("platforms", report["platforms"], F.col("platform"), F.col("storefront"), F.col("platform_code")))
    if "sample_games" in report:
        found.append(part("sample_games", report["sample_games"], F.col("game_name"), F.col("genre"), F.col("release_year")))
    if "revenue_sanity" in report:
        sanity = report["revenue_sanity"]
        found.append(part("revenue_sanity", sanity.unpivot([], sanity.columns, "item", "value"), F.col("item"), F.lit(None), F.col("value")))
    return reduce(DataFrame.unionByName, found)


def _missing(df: DataFrame, c: str) -> F.Column:
    """NULL, or NaN for floating columns (what a pandas null check counts)."""
    dtype = df.schema[c].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def null_counts(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """(column_name, null_count) for every column, in one aggregate; zero rows dropped by default."""
    wide = df.agg(*[F.sum(_missing(df, c).cast("bigint")).alias(c) for c in df.columns])
    wide = wide.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column_name", "null_count")
    return long.filter(F.col("null_count") > 0) if only_positive else long


def nonfinite_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, pos_inf, neg_inf, nan, null) counts per floating column."""
    cols = [c for c in columns if c in df.columns]
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [
            F.sum((x == F.lit(POS_INF)).cast("bigint")).alias(f"{c}__pos_inf"),
            F.sum((x == F.lit(NEG_INF)).cast("bigint")).alias(f"{c}__neg_inf"),
            F.sum(F.isnan(x).cast("bigint")).alias(f"{c}__nan"),
            F.sum(x.isNull().cast("bigint")).alias(f"{c}__null"),
        ]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.coalesce(F.col(f"{c}__{k}"), F.lit(0)).cast("bigint").alias(f"n_{k}") for k in ("pos_inf", "neg_inf", "nan", "null")]
        )
        for c in cols
    ]))
    return wide.select(rows.alias("r")).select("r.*")


def value_distribution(df: DataFrame, col: str, digits: int = 3) -> DataFrame:
    """Relative frequency of each non-NULL value, rounded; most frequent first."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    # The total is summed over the aggregated rows (one per distinct value).
    total = F.sum("_n").over(Window.partitionBy())
    out = counts.select(col, round_half_up(F.col("_n") / total, digits).alias("proportion"))
    return out.orderBy(F.desc("proportion"), F.asc(col))


def frame_shape(frames: dict[str, DataFrame]) -> DataFrame:
    """(frame, n_rows, n_columns) per named frame."""
    parts = [
        df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).select(
            F.lit(name).alias("frame"), "n_rows", F.lit(len(df.columns)).cast("int").alias("n_columns")
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)

