"""Query catalog: every registered report, check and model step as f(spark, sf_dir) -> DataFrame.

Each query reads the staged star schema (built once per input folder by
:mod:`tessera.sources.stage`) or the flat observation source behind it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numeric import round_half_up
from tessera.operators import checks, features, metrics, models, reports, sampling, star, summaries
from tessera.schema import (
    CAT_COLS,
    DROP_COLS,
    LEAKY_FEATURE,
    MODEL_COLS,
    RANDOM_STATE,
    SAMPLE_SIZE,
    STAR_TABLE_ORDER,
    STAR_TABLES,
    TARGET_COL,
)
from tessera.sources import files, stage

QueryFn = Callable[[SparkSession, str], DataFrame]

# Size of the standalone sampling demonstration (the models are fitted on the whole train part).
DEMO_SAMPLE_SIZE = 5_000
# Deterministic stand-in for a model score, used to check the evaluation maths
# against the oracle: players/49*0.5 + hype*5 + is_aaa*0.3, positive at >= 0.7.
SCORE_THRESHOLD = 0.7
# Training rows of one task: so many until all cores are busy, then up to the second number.
TRAIN_ROWS_PER_PARTITION, MOST_TRAIN_ROWS_PER_PARTITION = 50_000, 250_000
# A packed CSV file is read by one task: about 100 MB of text.
CSV_ROWS_PER_FILE = 250_000
# Attributes whose dependence on the publisher is audited beside the dimensions.
PUBLISHER_COLS = ["publisher", "publisher_tier", "genre", "genre_code"]


# ---------------------------------------------------------------------------
# Table access
# ---------------------------------------------------------------------------

def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return stage.table(spark, sf, name)


def _rows(spark: SparkSession, sf: str, name: str) -> int:
    return stage.table_rows(spark, sf, name)


def _summary(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return stage.summary(spark, sf, name)


def _profile(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return _summary(spark, sf, "profile").filter(F.col("table_name") == table)


def fact(spark, sf):
    return _t(spark, sf, "fact_weekly_metrics")


def observations(spark, sf):
    return _t(spark, sf, "observations")


def dim_games(spark, sf):
    return _t(spark, sf, "dim_games")


def dim_platform(spark, sf):
    return _t(spark, sf, "dim_platform")


def dim_time(spark, sf):
    return _t(spark, sf, "dim_time")


def model_frame(spark, sf):
    """The modelling subset: identifiers, categorical and numeric features, targets."""
    return observations(spark, sf).select(*MODEL_COLS)


def deterministic_score() -> F.Column:
    return F.col("concurrent_players") / 49 * 0.5 + F.col("hype_score") * 5 + F.col("is_aaa") * 0.3


# ---------------------------------------------------------------------------
# Modelling workflow (prepared once per stage, written to the stage folder)
# ---------------------------------------------------------------------------

@dataclass
class Prepared:
    split_path: str
    map_path: str
    features_v1: list[str]
    features_v2: list[str]


_PREPARED: dict[tuple, Prepared] = {}
_FITTED: dict[tuple, models.FittedModel] = {}


def prepared(spark: SparkSession, sf: str) -> Prepared:
    """Label-encode and split the whole modelling frame, written once."""
    with stage.BUILD_LOCK:
        return _prepared(spark, sf)


def _prepared(spark: SparkSession, sf: str) -> Prepared:
    st = stage.stage(spark, sf)
    key = (spark.sparkContext.applicationId, st.root)
    if key in _PREPARED:
        return _PREPARED[key]
    suffix = f"{RANDOM_STATE}_{_model_version()}"
    split_path = f"{st.root}/model_split_{suffix}"
    map_path = f"{st.root}/model_label_map_{suffix}"
    if not all(stage.written(spark, p) for p in (map_path, split_path)):
        frame = model_frame(spark, sf)
        features.label_map(frame, CAT_COLS).write.mode("overwrite").parquet(map_path)
        mapping = spark.read.parquet(map_path)
        # Split first: the counting passes of the split then look up no codes.
        split = sampling.stratified_split(frame, TARGET_COL, seed=RANDOM_STATE)
        encoded, _ = features.label_encode(split, CAT_COLS, mapping)
        encoded.write.mode("overwrite").option("compression", "zstd").parquet(split_path)
    f1 = features.feature_list(MODEL_COLS, DROP_COLS, TARGET_COL, extra_drop=["obs_key"])
    f2 = [c for c in f1 if c != LEAKY_FEATURE]
    prep = Prepared(split_path, map_path, f1, f2)
    _PREPARED[key] = prep
    return prep


def _split(spark, sf) -> DataFrame:
    return spark.read.parquet(prepared(spark, sf).split_path)


def _train_test(spark, sf) -> tuple[DataFrame, DataFrame]:
    s = _split(spark, sf)
    return s.filter(F.col("split") == "train").drop("split"), s.filter(F.col("split") == "test").drop("split")


def fitted(spark: SparkSession, sf: str, name: str) -> models.FittedModel:
    """Fit (once per session and stage) on the whole train part one of: logistic_regression, gbt_v1, gbt_v2."""
    with stage.BUILD_LOCK:
        return _fitted(spark, sf, name)


def _model_version() -> str:
    """Hash of the code that shapes a fitted model's outputs (a change refits)."""
    import hashlib
    import inspect

    from tessera import schema
    from tessera.functions import categorical, numeric
    from tessera.operators import joins, newton, ordered

    src = "".join(inspect.getsource(m) for m in (models, newton, features, sampling, ordered, schema, categorical, numeric, joins))
    src += inspect.getsource(_fitted) + inspect.getsource(_prepared)
    return hashlib.sha1(src.encode()).hexdigest()[:12]


def train_partitions(rows: int, cores: int) -> int:
    """An iterative fit runs several small jobs per iteration, so per-task overhead counts: few
    tasks for few rows, one for each core for more, and no task grows with the table."""
    return max(1, min(cores, -(-rows // TRAIN_ROWS_PER_PARTITION)), -(-rows // MOST_TRAIN_ROWS_PER_PARTITION))


def _fitted(spark: SparkSession, sf: str, name: str) -> models.FittedModel:
    st = stage.stage(spark, sf)
    key = (spark.sparkContext.applicationId, st.root, name)
    if key in _FITTED:
        return _FITTED[key]
    root = f"{st.root}/models_{_model_version()}/{name}"
    loaded = models.load(spark, name, root)
    if loaded is not None:
        _FITTED[key] = loaded
        return loaded
    prep = prepared(spark, sf)
    train, test = _train_test(spark, sf)
    w = features.class_weights(train, TARGET_COL).first().asDict()
    feats = prep.features_v2 if name == "gbt_v2" else prep.features_v1
    kind = "balanced" if name == "logistic_regression" else "pos_ratio"
    train = train.select(*feats, TARGET_COL).repartition(train_partitions(w["n_rows"], spark.sparkContext.defaultParallelism))
    tr = models.persist(features.with_weight(train, TARGET_COL, w, kind))
    if name == "logistic_regression":
        fm = models.fit_logistic(tr, test, feats, TARGET_COL, "weight")
    else:
        fm = models.fit_boosted_trees(name, tr, test, feats, TARGET_COL, "weight")
    # Scored test rows, importances and the model are written once; later queries
    # (in this or another process) read them instead of refitting.
    fm = models.save(spark, fm, root)
    tr.unpersist()
    _FITTED[key] = fm
    return fm


# ---------------------------------------------------------------------------
# Registered queries
# ---------------------------------------------------------------------------

def q_fact_weekly_metrics(spark, sf):
    return fact(spark, sf)


def q_dim_games(spark, sf):
    return dim_games(spark, sf)


def q_dim_platform(spark, sf):
    return dim_platform(spark, sf)


def q_dim_time(spark, sf):
    return dim_time(spark, sf)


def q_observations(spark, sf):
    return observations(spark, sf)


def q_fd_audit(spark, sf):
    """Conflicting keys per dimension column, from the key states written with the dimensions."""
    parts = [summaries.conflict_counts(_summary(spark, sf, f"key_states/{name}"), name, key) for name, (key, _) in STAR_TABLES.items()]
    return reduce(DataFrame.unionByName, parts)


def q_fd_conflicts(spark, sf):
    """The conflicts by name: those of the dimensions, and those of the publisher's own attributes,
    which are no dimension (a publisher may have several tiers and genres)."""
    parts = [summaries.conflicts(_summary(spark, sf, f"key_states/{name}"), _summary(spark, sf, f"key_tuples/{name}"), name, key)
             for name, (key, _) in STAR_TABLES.items()]
    tuples = star.key_tuples(observations(spark, sf), "publisher", PUBLISHER_COLS)
    parts.append(summaries.conflicts(summaries.key_states(tuples, "publisher"), tuples, "publishers", "publisher"))
    return reduce(DataFrame.unionByName, parts)


def q_row_counts(spark, sf):
    return summaries.row_counts(_summary(spark, sf, "profile").filter(F.col("table_name").isin(STAR_TABLE_ORDER)))


def q_row_count_check(spark, sf):
    return checks.row_count_check(spark, q_row_counts(spark, sf))


def q_verification_passed(spark, sf):
    """Overall verification flag: every star table meets its minimum row count."""
    return q_row_count_check(spark, sf).agg(F.bool_and("passed").alias("all_passed"))


def q_verification_report(spark, sf):
    """The whole verification step as rows: count checks, platforms, sample games, revenue sanity."""
    report, _ = checks.verification_report(spark, {n: _t(spark, sf, n) for n in STAR_TABLE_ORDER})
    return checks.report_rows(report)


def q_star_round_trip(spark, sf):
    """Rows and columns of each star table as read back from its written files."""
    tables = {n: _t(spark, sf, n) for n in STAR_TABLE_ORDER}
    counts = checks.row_counts(tables)
    widths = spark.createDataFrame([(n, len(df.columns)) for n, df in tables.items()], "table_name string, n_columns int")
    return counts.join(widths, "table_name", "inner").select("table_name", "row_count", "n_columns")


def q_platform_list(spark, sf):
    return checks.platform_list(dim_platform(spark, sf))


def q_sample_games(spark, sf):
    return checks.sample_games(dim_games(spark, sf))


def q_revenue_sanity(spark, sf):
    return checks.revenue_sanity(fact(spark, sf))


def q_genre_revenue(spark, sf):
    return reports.genre_revenue(fact(spark, sf), dim_games(spark, sf), _rows(spark, sf, "dim_games"))


def q_genre_chart_series(spark, sf):
    return reports.genre_chart_series(q_genre_revenue(spark, sf))


def q_genre_skew(spark, sf):
    rep = reports.genre_revenue(fact(spark, sf), dim_games(spark, sf), _rows(spark, sf, "dim_games"), top=None)
    return reports.genre_skew(rep)


def q_lifecycle(spark, sf):
    return reports.lifecycle(fact(spark, sf))


def q_lifecycle_ordered(spark, sf):
    return reports.lifecycle_ordered(fact(spark, sf))


def q_lifecycle_chart_series(spark, sf):
    return reports.lifecycle_chart_series(q_lifecycle_ordered(spark, sf))


def q_platform_comparison(spark, sf):
    return reports.platform_comparison(fact(spark, sf), dim_platform(spark, sf), _rows(spark, sf, "dim_platform"), _summary(spark, sf, "games_seen"))


def q_platform_report(spark, sf):
    return reports.platform_report(q_platform_comparison(spark, sf))


def q_platform_chart_series(spark, sf):
    return reports.platform_chart_series(q_platform_comparison(spark, sf))


def q_discount_effect(spark, sf):
    return reports.discount_effect(fact(spark, sf))


def q_discount_effect_clean(spark, sf):
    return reports.discount_effect(fact(spark, sf), clean=True)


def q_discount_bucket_edges(spark, sf):
    return reports.discount_bucket_edges(fact(spark, sf))


def q_discount_chart_series(spark, sf):
    return reports.discount_chart_series(q_discount_effect(spark, sf))


def q_discount_by_phase(spark, sf):
    return reports.discount_by_phase(fact(spark, sf))


def q_flag_label_crosstab(spark, sf):
    return reports.flag_label_crosstab(dim_games(spark, sf))


def q_calendar_rollup(spark, sf):
    return reports.calendar_rollup(fact(spark, sf), dim_time(spark, sf), _rows(spark, sf, "dim_time"))


def q_nonfinite_audit(spark, sf):
    """Non-finite values of the fact's floating columns, from its profile."""
    floating = [f.name for f in fact(spark, sf).schema.fields if f.dataType.typeName() in ("double", "float")]
    return summaries.nonfinite_audit(_profile(spark, sf, "fact_weekly_metrics"), floating)


def q_observation_null_counts(spark, sf):
    return summaries.null_counts(_profile(spark, sf, "observations"))


def q_null_counts(spark, sf):
    """Missing values of the modelling frame, a projection of the observations."""
    return summaries.null_counts(_profile(spark, sf, "observations"), MODEL_COLS)


def q_column_profile(spark, sf):
    """Rows, NULLs and non-finite values of every column of the observations."""
    return _profile(spark, sf, "observations").select("column_name", *summaries.PROFILE_COUNTS)


def q_unique_games(spark, sf):
    """Distinct games by platform and phase, by each of them and in all, regrouped from one set of bitmaps."""
    seen = _summary(spark, sf, "games_seen")
    parts = []
    for level, groups in (("platform_phase", ["platform_code", "launch_phase"]), ("platform", ["platform_code"]), ("phase", ["launch_phase"]), ("all", [])):
        counts = summaries.distinct_counts(seen, groups, "unique_games")
        shown = [F.col(c) if c in groups else F.lit(None).cast(seen.schema[c].dataType).alias(c) for c in ("platform_code", "launch_phase")]
        parts.append(counts.select(F.lit(level).alias("level"), *shown, "unique_games"))
    return reduce(DataFrame.unionByName, parts)


def q_target_distribution(spark, sf):
    return checks.value_distribution(model_frame(spark, sf), TARGET_COL)


def q_sample_target_distribution(spark, sf):
    """Distribution over the part that the models are fitted on."""
    return checks.value_distribution(_train_test(spark, sf)[0], TARGET_COL)


def q_frame_shape(spark, sf):
    prep = prepared(spark, sf)
    train, test = _train_test(spark, sf)
    return checks.frame_shape({
        "full": model_frame(spark, sf),
        "fit": sampling.exact_sample(train, SAMPLE_SIZE, RANDOM_STATE).select(*prep.features_v1),
        "train": train.select(*prep.features_v1),
        "test": test.select(*prep.features_v1),
    })


def q_exact_sample(spark, sf):
    s = sampling.exact_sample(model_frame(spark, sf), DEMO_SAMPLE_SIZE, RANDOM_STATE)
    return s.select("obs_key", "game_id", TARGET_COL)


def q_stratified_split(spark, sf):
    return _split(spark, sf).select("obs_key", TARGET_COL, "split")


def q_split_balance(spark, sf):
    return sampling.split_balance(_split(spark, sf), TARGET_COL)


def q_label_map(spark, sf):
    return spark.read.parquet(prepared(spark, sf).map_path)


def q_label_encode(spark, sf):
    return _split(spark, sf).select("obs_key", *CAT_COLS)


def q_feature_columns(spark, sf):
    """The columns that strict drops leave of the prepared training frame, with and without the leaky one."""
    train, _ = _train_test(spark, sf)
    v1 = features.drop_columns(train, [*DROP_COLS, "obs_key", TARGET_COL])
    return features.feature_columns(spark, {"v1": v1, "v2": features.drop_columns(v1, [LEAKY_FEATURE])})


def q_class_weights(spark, sf):
    train, _ = _train_test(spark, sf)
    return features.class_weights(train, TARGET_COL)


def _scored_test(spark, sf):
    _, test = _train_test(spark, sf)
    return test.select(
        "obs_key",
        F.col(TARGET_COL).alias("label"),
        deterministic_score().alias("score"),
    ).withColumn("prediction", (F.col("score") >= SCORE_THRESHOLD).cast("int"))


def q_classification_report(spark, sf):
    return metrics.classification_report(_scored_test(spark, sf), "label", "prediction")


def q_roc_auc(spark, sf):
    auc = metrics.roc_auc(_scored_test(spark, sf), "label", "score")
    return auc.select(round_half_up("roc_auc", 6).alias("roc_auc"))


def q_lr_metrics(spark, sf):
    return models.evaluate(fitted(spark, sf, "logistic_regression"))


def q_gbt_v1_metrics(spark, sf):
    return models.evaluate(fitted(spark, sf, "gbt_v1"))


def q_gbt_v2_metrics(spark, sf):
    return models.evaluate(fitted(spark, sf, "gbt_v2"))


def q_model_comparison(spark, sf):
    parts = [models.evaluate(fitted(spark, sf, n)) for n in ("logistic_regression", "gbt_v1", "gbt_v2")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_predictions(spark, sf):
    return fitted(spark, sf, "gbt_v2").predictions


def q_feature_importance_v1(spark, sf):
    return models.importance_frame(spark, fitted(spark, sf, "gbt_v1"))


def q_feature_importance_v2(spark, sf):
    return models.importance_frame(spark, fitted(spark, sf, "gbt_v2"))


def q_leak_flag(spark, sf):
    return models.leak_flag(q_feature_importance_v1(spark, sf))


def q_describe_source(spark, sf):
    return files.describe(spark, observations(spark, sf))


def q_source_width(spark, sf):
    return files.width(spark, observations(spark, sf))


def observations_csv(spark, sf) -> str:
    """Path of the flat source written as CSV (inf/NaN as text), written on first use."""
    src = observations(spark, sf)
    path = f"{stage.stage(spark, sf).root}/observations_csv"
    if not stage.written(spark, path):
        files.write_csv(src, path, compression="gzip", rows_per_file=CSV_ROWS_PER_FILE)
    return path


def q_csv_round_trip(spark, sf):
    """The flat source written as CSV and read back with its declared schema."""
    return files.read_csv(spark, observations_csv(spark, sf), observations(spark, sf).schema)


def q_describe_csv_source(spark, sf):
    """Column names of the CSV source, and the least type that holds all texts of each."""
    return files.describe(spark, files.read_csv(spark, observations_csv(spark, sf)))


def q_file_inventory(spark, sf):
    return files.file_inventory(spark, sf)


QUERIES: dict[str, QueryFn] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
