"""Exact discrete quantile, distributed.

Semantics: the element of 1-based rank ``ceil(q * n)`` among the ``n``
non-null values (``q = 0`` gives the minimum, ``q = 1`` the maximum), i.e.
what an exact quantile summary returns. Ties do not matter: every value of
that rank is the same number.

``percentile_disc`` gives the same value but aggregates into one
O(distinct values) buffer in a single task. At scale that does not fit, so
the selection narrows an open interval of values, alike at every size:

1. one pass: ``percentile_approx`` at ``q ± 2/A`` brackets the target rank by
   two values of the interval;
2. one pass: rows below the lower value, equal to it, between the two, equal
   to the upper one. If the rank falls on either value, that value is the
   answer. Otherwise the search goes on strictly between them (or strictly
   beside them, if the bracket missed), with a shifted rank.

The values tried leave the interval, so every round makes it smaller, and by
about ``A / 4`` when the bracket holds; once it has fewer rows than ``A / 2``
the bracket is the answer itself. Ties never stop it: they are counted, not
sorted. Only a few numbers per pass come back to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.functions.metrics import THRESHOLD_QUANTILE, UNDERPERFORMANCE_THRESHOLD
from haulwise.session import cut_lineage

DEFAULT_ACCURACY = 20_000

def _ranks(n: int, qs: list[float]) -> list[int]:
    out = []
    for q in qs:
        if q <= 0.0:
            out.append(1)
        elif q >= 1.0:
            out.append(n)
        else:
            out.append(min(max(math.ceil(q * n), 1), n))
    return out


def _inside(lo, hi):
    """Strictly between two values (None: open)."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("m") > F.lit(lo))
    if hi is not None:
        cond = cond & (F.col("m") < F.lit(hi))
    return cond


def _brackets(state: dict, accuracy: int) -> list:
    out = []
    for i, (lo, hi, r, n) in state.items():
        p = [max((r / n) - 2.0 / accuracy, 0.0), min((r / n) + 2.0 / accuracy, 1.0)]
        value = F.when(_inside(lo, hi), F.col("m"))
        out.append(F.percentile_approx(value, F.array(*map(F.lit, p)), accuracy).alias(f"q{i}"))
    return out


def select_ranks(values: DataFrame, col: str, ranks: list[int], *,
                 count: int | None = None,
                 accuracy: int = DEFAULT_ACCURACY,
                 first_brackets: dict | None = None) -> list:
    """Values of several 1-based ranks among the non-null values of
    ``col``, narrowing all intervals in shared passes (one
    ``percentile_approx`` pass and one counting pass per round, whatever the
    number of ranks). ``first_brackets`` (rank index -> (lo, hi)) replaces the
    first bracketing pass when the caller computed it alongside the count."""
    base = values.select(F.col(col).alias("m")).where(F.col("m").isNotNull())
    n = count if count is not None else base.count()
    result: list = [None] * len(ranks)
    # per rank: open interval (None: no bound), rank in it, rows in it
    state = {i: (None, None, r, n) for i, r in enumerate(ranks) if 1 <= r <= n}
    while state:
        if first_brackets is not None:
            brackets, first_brackets = {f"q{i}": first_brackets[i] for i in state}, None
        else:
            brackets = base.agg(*_brackets(state, accuracy)).first()
        counts = []
        for i, (lo, hi, _, _) in state.items():
            a, b = brackets[f"q{i}"]
            m, own = F.col("m"), _inside(lo, hi)
            counts += [F.count_if(own & (m < a)).alias(f"below{i}"), F.count_if(own & (m == a)).alias(f"low{i}"),
                       F.count_if(own & (m > a) & (m < b)).alias(f"mid{i}"),
                       F.count_if(own & (m == b) & (m > a)).alias(f"high{i}")]
        row = base.agg(*counts).first()
        for i, (lo, hi, r, cnt) in list(state.items()):
            a, b = brackets[f"q{i}"]
            below, low, mid, high = (row[f"{k}{i}"] for k in ("below", "low", "mid", "high"))
            if r <= below:
                state[i] = (lo, a, r, below)
            elif r <= below + low:
                result[i] = a
                del state[i]
            elif r <= below + low + mid:
                state[i] = (a, b, r - below - low, mid)
            elif r <= below + low + mid + high:
                result[i] = b
                del state[i]
            else:
                done = below + low + mid + high
                state[i] = (b, hi, r - done, cnt - done)
    return result


def kth_smallest(values: DataFrame, col: str, rank: int, **kw):
    """Value of 1-based ``rank`` among the non-null values of ``col``."""
    return select_ranks(values, col, [rank], **kw)[0]


def discrete_quantiles(df: DataFrame, col: str, qs: list[float], *,
                       materialize: bool = True,
                       accuracy: int = DEFAULT_ACCURACY) -> list:
    """Exact discrete quantiles of ``col`` (None each when all null).

    With ``materialize`` the single column is first written to the shared
    checkpoint folder so the passes do not recompute ``df``'s lineage."""
    vals = df.select(F.col(col).alias("m")).where(F.col("m").isNotNull())
    if materialize:
        vals = cut_lineage(vals, "quantile")
    # one pass: the count and a first bracket around each quantile (the
    # counting pass in select_ranks verifies the brackets, so exactness does
    # not depend on them)
    brackets = [F.percentile_approx(
        "m", F.array(F.lit(max(q - 2.0 / accuracy, 0.0)), F.lit(min(q + 2.0 / accuracy, 1.0))),
        accuracy).alias(f"q{i}") for i, q in enumerate(qs)]
    row = vals.agg(F.count(F.lit(1)).alias("n"), *brackets).first()
    n = row["n"]
    if n == 0:
        return [None] * len(qs)
    first = {i: tuple(row[f"q{i}"]) for i in range(len(qs))}
    return select_ranks(vals, "m", _ranks(n, list(qs)), count=n, accuracy=accuracy, first_brackets=first)


def discrete_quantile(df: DataFrame, col: str, q: float, **kw):
    """Exact discrete quantile of ``col`` (None when every value is null)."""
    return discrete_quantiles(df, col, [q], **kw)[0]


def compute_underperformance_threshold(df: DataFrame,
                                       margin_col: str = "gross_margin_pct",
                                       q: float = THRESHOLD_QUANTILE,
                                       fallback: float = UNDERPERFORMANCE_THRESHOLD,
                                       **kw) -> float:
    """Data-driven floor: the exact discrete ``q`` quantile of the margin,
    rounded to a whole number half-to-even; ``fallback`` when all null."""
    v = discrete_quantile(df, margin_col, q, **kw)
    if v is None:
        return float(fallback)
    return float(round(v))
