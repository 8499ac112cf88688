"""Star-schema construction: dimensions, fact table and a functional-dependency audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import summaries
from tessera.schema import DIM_GAMES_COLS, DIM_PLATFORM_COLS, DIM_TIME_COLS, FACT_COLS, STAR_TABLES


def contract(df: DataFrame, cols: list[str], carried: list[str] | None = None) -> list[str]:
    """``cols``, or those of them that are ``carried``, in contract order.

    Every one must be in ``df``: a source that lacks a column of the contract is an
    error unless its caller names the subset that it carries.
    """
    wanted = [c for c in cols if carried is None or c in carried]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise KeyError(f"the source lacks columns of the contract: {missing}")
    return wanted


def key_tuples(flat: DataFrame, key: str, cols: list[str], carried: list[str] | None = None) -> DataFrame:
    """The distinct rows of ``cols`` with their ``n_rows``: about one per key, since the other
    columns are (by contract) constant per key.  A map-side hash aggregate collapses the input."""
    return flat.groupBy(*contract(flat, cols, carried)).agg(F.count(F.lit(1)).alias("n_rows"))


def collapse(tuples: DataFrame, key: str) -> DataFrame:
    """One row per natural key of :func:`key_tuples`, every other column by ANY_VALUE.

    ``any_value`` over string buffers cannot use the hash aggregate and would sort the whole
    input; here it runs on the small remainder.  ``ignoreNulls`` keeps a non-NULL value when
    one exists.
    """
    cols = [c for c in tuples.columns if c != "n_rows"]
    attrs = [c for c in cols if c != key]
    if not attrs:
        return tuples.select(key)
    return tuples.groupBy(key).agg(*[F.any_value(c, True).alias(c) for c in attrs]).select(*cols)


def dimension(flat: DataFrame, key: str, cols: list[str], carried: list[str] | None = None) -> DataFrame:
    """One row per natural key of the flat source."""
    return collapse(key_tuples(flat, key, cols, carried), key)


def dim_games(flat: DataFrame, carried: list[str] | None = None) -> DataFrame:
    return dimension(flat, "game_id", DIM_GAMES_COLS, carried)


def dim_platform(flat: DataFrame, carried: list[str] | None = None) -> DataFrame:
    return dimension(flat, "platform_code", DIM_PLATFORM_COLS, carried)


def dim_time(flat: DataFrame, carried: list[str] | None = None) -> DataFrame:
    return dimension(flat, "obs_date", DIM_TIME_COLS, carried)


def fact_weekly_metrics(flat: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """Plain projection of the time-varying columns; no row is merged or dropped."""
    return flat.select(*contract(flat, FACT_COLS, carried))


def fd_audit(flat: DataFrame) -> DataFrame:
    """Keys whose supposedly static attributes disagree, per dimension column.

    Returns (table_name, column_name, conflicting_keys): the number of keys for
    which the column holds more than one distinct non-NULL value, i.e. where
    ANY_VALUE's choice would matter.  Audits whatever columns the source carries; a staged
    source has the key states already (:mod:`tessera.operators.summaries`).
    """
    parts = []
    for table, (key, cols) in STAR_TABLES.items():
        if key in flat.columns and any(c in flat.columns for c in cols if c != key):
            parts.append(summaries.conflict_counts(summaries.key_states(key_tuples(flat, key, cols, flat.columns), key), table, key))
    return reduce(DataFrame.unionByName, parts)
