"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when its exact row count is known to be at most this
# many rows.  Dimension rows here are < 200 bytes, so this keeps a broadcast well
# under ~100 MB; bigger sides take the shuffle join (AQE may still convert it at
# runtime from measured sizes and splits skewed partitions).
MAX_BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, rows: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Return ``df`` with a broadcast hint when its row count is at most ``max_rows``.

    ``rows`` may be supplied when the count is already known (for example from the
    star-schema manifest); otherwise it is counted, so call this only on stored
    tables or other cheap-to-count inputs, never on a large derived plan.
    """
    limit = MAX_BROADCAST_ROWS if max_rows is None else max_rows  # read at call time: configurable
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def sized_join(big: DataFrame, small: DataFrame, on, how: str = "inner", small_rows: int | None = None,
               max_rows: int | None = None) -> DataFrame:
    """Join ``big`` with ``small``, broadcasting ``small`` only behind a size check."""
    return big.join(broadcast_if_small(small, small_rows, max_rows), on=on, how=how)
