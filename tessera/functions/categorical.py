"""Categorical expressions: discount buckets, lifecycle phases and their order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schema import DISCOUNT_BUCKETS, PHASE_DAY_LIMITS, PHASE_ORDER


def discount_bucket(col: Column | str = "discount_pct") -> Column:
    """Six half-open discount ranges; NULL and negative values fall to the last label."""
    c = F.col(col) if isinstance(col, str) else col
    labels = [label for label, _, _ in DISCOUNT_BUCKETS]
    expr = F.when(c == 0, F.lit(labels[0]))
    for label, low, high in DISCOUNT_BUCKETS[1:-1]:
        lower = (c > low) if low == 0 else (c >= low)
        expr = expr.when(lower & (c < high), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def phase_rank(col: Column | str = "launch_phase") -> Column:
    """1-based chronological rank of a lifecycle phase; unknown or NULL -> NULL (sorts last)."""
    c = F.col(col) if isinstance(col, str) else col
    order = F.array(*[F.lit(p) for p in PHASE_ORDER])
    return F.nullif(F.array_position(order, c), F.lit(0)).cast("int")


def launch_phase(days: Column) -> Column:
    """Lifecycle phase from days since release (limits in ``PHASE_DAY_LIMITS``)."""
    expr = F.when(days < PHASE_DAY_LIMITS[0], F.lit(PHASE_ORDER[0]))
    for limit, phase in zip(PHASE_DAY_LIMITS[1:], PHASE_ORDER[1:]):
        expr = expr.when(days < limit, F.lit(phase))
    return expr.otherwise(F.lit(PHASE_ORDER[-1]))


def as_label_text(col: Column | str) -> Column:
    """Text form of a categorical value; missing values become the text 'nan'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit("nan"))
