"""Scalar numeric helpers: deterministic rounding, non-finite handling, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POS_INF = float("inf")
NEG_INF = float("-inf")


def round_half_up(col: Column | str, digits: int) -> Column:
    """ROUND to ``digits``, exact ties (0.285 at two digits) up on every engine.

    Engines disagree on such ties of doubles; fifteen decimal places hold them and
    keep every value that is not a tie on its side.  Values that a decimal(38,15)
    cannot hold, and inf and NaN, take plain ROUND.
    """
    c = F.col(col) if isinstance(col, str) else col
    c = c.cast("double")
    return F.when(F.abs(c) < F.lit(1e20), F.round(F.when(F.abs(c) < F.lit(1e20), c).cast("decimal(38,15)"), digits).cast("double")).otherwise(F.round(c, digits))


def round_plain(col: Column | str, digits: int) -> Column:
    """Plain ROUND on a double; keeps inf and NaN (used for raw, unclean measures)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, digits)


def is_finite(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return ~F.isnan(c) & (F.abs(c) != F.lit(POS_INF))


def finite_or_null(col: Column | str) -> Column:
    """Replace +inf, -inf and NaN by NULL so aggregates skip them."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(is_finite(c), c)


def growth_rate(current: Column, previous: Column) -> Column:
    """(current - previous) / previous with IEEE results for a zero base.

    previous NULL -> NULL; previous 0 -> +inf / -inf / NaN by the sign of the
    numerator (what a float division by zero yields); else the plain ratio.
    """
    cur = current.cast("double")
    prev = previous.cast("double")
    diff = cur - prev
    return (
        F.when(prev.isNull(), F.lit(None).cast("double"))
        .when(prev == 0, F.when(diff > 0, F.lit(POS_INF)).when(diff < 0, F.lit(NEG_INF)).otherwise(F.lit(float("nan"))))
        .otherwise(diff / prev)
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio that yields 0.0 when the denominator is 0 (report convention)."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator.cast("double") / denominator.cast("double"))
