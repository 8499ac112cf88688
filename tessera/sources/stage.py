"""Write-once staging of the flat source and the star schema.

The observation source is expensive to derive (joins, per-game windows) and every
report reads some slice of it, so it is written once as Parquet together with the
four star tables, under the shared work folder (``spark.checkpoint.dir``).  The
written tables also cut lineage: a lost executor re-reads files instead of
recomputing the derivation.

Layout: ``<work>/tessera-stage/<fingerprint>/data-<id>/{observations,dim_games,...}``, beside
them the summaries (column profiles, key tuples and states, bitmaps of the games seen).
The fingerprint covers the source folder and the size/mtime of its files, so a
changed input gets a fresh folder.  It is taken once a session for each source;
:func:`refresh` takes it anew.  A stage is a published version (``versions``): its
pointer, with the row counts, is written last, and of several builders of one stage
the first to publish wins.  The counts also serve as size bounds for broadcasts.
"""

from __future__ import annotations

import hashlib
import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera.operators import star, summaries
from tessera.schema import FACT_COLS, STAR_TABLE_ORDER, STAR_TABLES
from tessera.session import work_dir
from tessera.sources import versions
from tessera.sources.observations import FLAT_COLS, observations

SOURCE_TABLES = ["lineitem", "part", "supplier", "nation", "region"]

# Target rows per Parquet file when staging; keeps files near 128 MB at scale.
ROWS_PER_FILE = 2_000_000


@dataclass
class Stage:
    root: str
    counts: dict[str, int]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


_STAGES: dict[tuple[str, str], Stage] = {}
# Serialises first builds: concurrent callers wait for one build instead of
# writing the same folders at once.
BUILD_LOCK = threading.RLock()


def _code_version() -> bytes:
    """Source text of the modules that define the staged tables: a code change
    gives a new stage folder instead of silently reusing stale tables."""
    import inspect

    from tessera import schema
    from tessera.functions import categorical, numeric
    from tessera.operators import joins
    from tessera.sources import observations as obs_mod

    return b"".join(inspect.getsource(m).encode() for m in (obs_mod, star, summaries, schema, categorical, numeric, joins))


def _listing(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files under ``path``, by the file source that reads it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    row = files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime").cast("string"),
                    F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).cast("string")).first()
    return "|".join(map(str, row))


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    h = hashlib.sha1(sf_dir.encode())
    h.update(_code_version())
    for name in SOURCE_TABLES:
        h.update(f"{name}:{_listing(spark, f'{sf_dir}/{name}.parquet')}".encode())
    return h.hexdigest()[:16]


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` to its end; any other failure than a missing path is raised."""
    try:
        spark.read.format("binaryFile").load(f"{path}/_SUCCESS").select("path").limit(1).count()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _published(spark: SparkSession, root: str) -> Stage | None:
    found = versions.current(spark, root)
    return Stage(found.path, {k: int(v) for k, v in found.info.items()}) if found else None


def _write(df: DataFrame, path: str) -> int:
    return versions.write_counted(df, path, ROWS_PER_FILE)


def with_row_key(flat: DataFrame, key: str = "obs_key") -> DataFrame:
    """Add a stable observation key when the source has none: md5 over every column's
    text with its length before it (NULL apart from empty), the identity used for
    seeded sampling.  Equal rows share a key, different rows never the same text."""
    if key in flat.columns:
        return flat
    texts = [F.col(f"`{c}`").cast("string") for c in flat.columns]
    parts = [F.when(t.isNull(), F.lit("N;")).otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t, F.lit(";"))) for t in texts]
    return flat.withColumn(key, F.md5(F.concat(*parts)))


def build_stage(spark: SparkSession, sf_dir: str, root: str) -> Stage:
    """Derive the flat source from the driver tables, then write it and the star schema."""
    return build_stage_from_flat(spark, observations(spark, sf_dir), root, FLAT_COLS)


def stage_csv(spark: SparkSession, csv_path: str, schema=None, root: str | None = None,
              carried: list[str] | None = None) -> Stage:
    """Ingest a flat observation CSV (header; 'inf'/'nan' as text) into a star schema.

    Pass the declared ``schema`` for production loads; without it types are
    inferred from all rows.  A CSV that lacks columns of the contract is an error
    unless ``carried`` names those it has.  A changed file gets a new folder.  The CSV is read once and
    staged as Parquet; the four tables are built from that Parquet copy.
    """
    from tessera.sources.files import read_csv

    root = root or f"{work_dir(spark)}/tessera-stage/csv-{_csv_key(spark, csv_path, schema, carried)}"
    with BUILD_LOCK:
        return _published(spark, root) or build_stage_from_flat(spark, read_csv(spark, csv_path, schema), root, carried)


def _csv_key(spark: SparkSession, path: str, schema, carried: list[str] | None) -> str:
    kind = schema if schema is None or isinstance(schema, str) else schema.json()
    said = f"{path}|{_listing(spark, path)}|{kind}|{carried}".encode()
    return hashlib.sha1(said + _code_version()).hexdigest()[:16]


def build_stage_from_flat(spark: SparkSession, flat_source: DataFrame, root: str, carried: list[str] | None = None) -> Stage:
    """Write the flat source and the four star tables as one version of ``root``, then publish it."""
    parent, root = root, versions.new_path(root)
    counts: dict[str, int] = {}
    counts["observations"] = _write(with_row_key(flat_source), f"{root}/observations")
    flat = spark.read.parquet(f"{root}/observations")
    for name, (key, cols) in STAR_TABLES.items():
        # The flat table is collapsed once; dimension and key states are made of what remains.
        star.key_tuples(flat, key, cols, carried).write.parquet(f"{root}/key_tuples/{name}")
        tuples = spark.read.parquet(f"{root}/key_tuples/{name}")
        counts[name] = _write(star.collapse(tuples, key), f"{root}/{name}")
        summaries.key_states(tuples, key).write.parquet(f"{root}/key_states/{name}")
    # Sorted by date within files: the least and greatest obs_date of each page then prune
    # date filters, without a shuffle of the whole table; the column is not used as a
    # directory partition (thousands of tiny folders).
    fact = star.fact_weekly_metrics(flat, None if carried is None else [*carried, "obs_key"])
    counts["fact_weekly_metrics"] = _write(fact.sortWithinPartitions("obs_date", "game_id", "obs_key"), f"{root}/fact_weekly_metrics")
    _write_profiles(spark, root, None if carried is None else [*carried, "obs_key"])
    _write_presence(spark, root)
    done = versions.publish(spark, parent, root, counts, first_only=True)
    return Stage(done.path, {k: int(v) for k, v in done.info.items()})


#: What the bitmaps of the games seen are kept by, as far as the fact table has it.
PRESENCE_GROUPS = ["platform_code", "launch_phase"]
#: Rows per game on average up to which the rows of games are not collapsed before they are dealt
#: out for the bitmaps, and rows of one game above which they are.
FEW_ROWS_PER_GAME, HOT_GAME_ROWS = 100, 200_000


def _write_profiles(spark: SparkSession, root: str, carried: list[str] | None) -> None:
    """Column profiles of all tables.  The fact table is a projection of the flat one, so its
    profile is part of that one's; the flat table is read once more, whole."""
    flat = spark.read.parquet(f"{root}/observations")
    profile = summaries.column_profile(flat)
    profile.write.parquet(f"{root}/profile/table_name=observations")
    whole = spark.read.parquet(f"{root}/profile/table_name=observations")
    facts = star.contract(flat, FACT_COLS, carried)
    whole.filter(F.col("column_name").isin(facts)).write.parquet(f"{root}/profile/table_name=fact_weekly_metrics")
    for name in STAR_TABLES:
        summaries.column_profile(spark.read.parquet(f"{root}/{name}")).write.parquet(f"{root}/profile/table_name={name}")


def _write_presence(spark: SparkSession, root: str) -> None:
    """Bitmaps of the games seen by platform and phase.  Game ids that are no integers are
    numbered by the dimension first."""
    fact = spark.read.parquet(f"{root}/fact_weekly_metrics")
    groups = [c for c in PRESENCE_GROUPS if c in fact.columns]
    key = "game_id"
    if fact.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        summaries.numbered_keys(spark.read.parquet(f"{root}/dim_games"), key).write.parquet(f"{root}/game_numbers")
        fact = fact.select(*groups, key).distinct().join(spark.read.parquet(f"{root}/game_numbers"), key)
        key = "key_number"
        hot = None
    else:
        hot = _hot_games(spark, root, key)
    summaries.presence(fact, groups, key, hot).write.parquet(f"{root}/games_seen")


def _hot_games(spark: SparkSession, root: str, key: str) -> DataFrame | None:
    """The games of more than HOT_GAME_ROWS rows, by the key states; None if games have many rows as a rule."""
    states = spark.read.parquet(f"{root}/key_states/dim_games").filter(F.col(key).isNotNull())
    size = states.agg(F.count(F.lit(1)).alias("games"), F.sum("n_rows").alias("n")).first()
    if (size["n"] or 0) > FEW_ROWS_PER_GAME * size["games"]:
        return None
    return states.filter(F.col("n_rows") > HOT_GAME_ROWS).select(key)  # at most one for each HOT_GAME_ROWS rows


def summary(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A summary of the staged tables: ``profile`` (with ``table_name``), ``games_seen``,
    ``key_tuples/<dimension>`` or ``key_states/<dimension>``."""
    return spark.read.parquet(stage(spark, sf_dir).path(name))


def stage(spark: SparkSession, sf_dir: str) -> Stage:
    """Return the staged tables for ``sf_dir``, building them on first use.

    Later calls of the session run no job: they take the source for unchanged until :func:`refresh`.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGES:
        with BUILD_LOCK:
            if key not in _STAGES:
                root = f"{work_dir(spark)}/tessera-stage/{_fingerprint(spark, sf_dir)}"
                _STAGES[key] = _published(spark, root) or build_stage(spark, sf_dir, root)
    return _STAGES[key]


def adopt(spark: SparkSession, sf_dir: str, staged: Stage) -> None:
    """Use ``staged`` for ``sf_dir`` in this session."""
    _STAGES[(spark.sparkContext.applicationId, sf_dir)] = staged


def refresh(spark: SparkSession, sf_dir: str) -> Stage:
    """Look at the source again: a changed one is staged anew."""
    with BUILD_LOCK:
        _STAGES.pop((spark.sparkContext.applicationId, sf_dir), None)
        return stage(spark, sf_dir)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A staged table by name: 'observations' or one of the four star tables."""
    return spark.read.parquet(stage(spark, sf_dir).path(name))


def table_rows(spark: SparkSession, sf_dir: str, name: str) -> int:
    return stage(spark, sf_dir).counts[name]


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Expose the staged tables as temp views (dim_games, dim_platform, dim_time,
    fact_weekly_metrics, observations) so SQL written against the star schema
    runs unchanged through ``spark.sql``."""
    st = stage(spark, sf_dir)
    names = ["observations", *STAR_TABLE_ORDER]
    for name in names:
        spark.read.parquet(st.path(name)).createOrReplaceTempView(name)
    return names
