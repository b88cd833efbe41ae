"""Column-level metric helpers. All are built-in Spark expressions, so they
stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fallback floor when the margin column is entirely null, and
# the default quantile of the data-driven floor.
UNDERPERFORMANCE_THRESHOLD = 10.0
THRESHOLD_QUANTILE = 0.10

# Decimal type of the exact part of a sum: values of at most six decimal
# places add up to the same bits in every order and engine.
EXACT_SUM_TYPE = "decimal(20,6)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """``num / den``, null when ``den`` is null or zero (or ``num`` null).

    Accepts column names or Columns. ``try_divide`` returns null for a zero
    divisor instead of raising under ANSI mode and leaves NaN as NaN.
    """
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def exact_sum(c) -> Column:
    """Sum of a double column that loses nothing.

    The decimal part of every value is summed exactly; what it leaves (digits
    past the sixth place, values too large for the type, NaN, infinity) is
    summed as double. For six-place values that rest is 0, and the sum does
    not depend on the order of the rows."""
    part, rest = exact_parts(c)
    return F.sum(part).cast("double") + F.sum(rest)


def exact_parts(c) -> tuple[Column, Column]:
    """A double as its six-place decimal and what that leaves over; null for
    null. Either can be summed in several steps."""
    v = _col(c).cast("double")
    part = F.coalesce(v.try_cast(EXACT_SUM_TYPE), F.lit(0).cast(EXACT_SUM_TYPE))
    part = F.when(v.isNotNull(), part)
    return part, v - part.cast("double")


def weighted_pct(num, den) -> Column:
    """Σnum / Σden * 100 — a revenue-weighted percentage at any grain
    (never a mean of row percentages)."""
    return safe_div(exact_sum(num), exact_sum(den)) * 100


def below_threshold(margin, threshold: float) -> Column:
    """``margin < threshold``: strict, and null for a null margin."""
    return _col(margin) < F.lit(float(threshold))


def threshold_text(threshold: float) -> str:
    """The threshold as it appears in reason text (``%g`` formatting)."""
    return f"{threshold:g}"
