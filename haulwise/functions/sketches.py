"""Summaries that are kept by partition and merged: quantile sketches (KLL)
and distinct-count sketches (HLL).

One row a partition of a table, so a load makes new ones only for the
partitions it changes, and a question about the whole table merges a few rows
in place of reading it. Both are estimates with a known error; where a number
must be exact, the sketch narrows down what has to be read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.functions.metrics import UNDERPERFORMANCE_THRESHOLD
from haulwise.functions.quantile import _ranks, select_ranks

KLL_K = 800
KLL_ERROR = 0.01  # of the rank, well above what a sketch of that size has
HLL_BITS = 14


def quantile_sketches(df: DataFrame, col: str, by: Sequence[str], k: int = KLL_K) -> DataFrame:
    """``(by, n, sketch)``: for each partition, how many values and their KLL
    sketch. Null values are in neither; a partition of nulls has none."""
    return df.where(F.col(col).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(k)).alias("sketch"))


def replace_partitions(held: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """The stored summaries with those of the partitions in ``new`` replaced."""
    return held.join(new.select(*by), list(by), "left_anti").unionByName(new)


def sketch_brackets(sketches: DataFrame, qs: Sequence[float], error: float = KLL_ERROR) -> tuple[int, list[tuple[float, float]]]:
    """(number of values, for every quantile two values that it is most
    likely between), from the merged sketches; one row to the driver."""
    at = [F.array(*[F.kll_sketch_get_quantile_double("s", F.lit(min(max(q + d, 0.0), 1.0))) for d in (-error, error)]).alias(f"q{i}")
          for i, q in enumerate(qs)]
    row = sketches.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("s")).where("n > 0").select("n", *at).first()
    return (row["n"], [tuple(row[f"q{i}"]) for i in range(len(qs))]) if row else (0, [])


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], sketches: DataFrame) -> list:
    """Exact discrete quantiles of ``col``. The sketches of the same rows give
    the count and a bracket for each quantile, which saves the pass that would
    find them; one pass counts the rows below, on and between the brackets'
    ends, and only rows inside are looked at further. Counting also tells a
    bracket that missed, so the result does not rest on the sketch."""
    n, brackets = sketch_brackets(sketches, qs)
    if not n:
        return [None] * len(qs)
    return select_ranks(df, col, _ranks(n, list(qs)), count=n, first_brackets=dict(enumerate(brackets)))


def threshold_from_sketches(df: DataFrame, col: str, q: float, sketches: DataFrame,
                            fallback: float = UNDERPERFORMANCE_THRESHOLD) -> float:
    """C25 with stored sketches: the exact quantile, rounded half to even."""
    v = exact_quantiles(df, col, [q], sketches)[0]
    return float(fallback) if v is None else float(round(v))


def distinct_sketches(df: DataFrame, col: str, by: Sequence[str], bits: int = HLL_BITS) -> DataFrame:
    """``(by, n, sketch)``: rows and the HLL sketch of the values, by partition."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(col, bits).alias("sketch"))


def distinct_estimate(sketches: DataFrame, bits: int = HLL_BITS, deviations: int = 3) -> DataFrame:
    """One row ``(partitions, row_count, estimate, low, high)``: the merged
    estimate of the distinct values, and bounds at so many standard errors."""
    error = deviations * 1.04 / math.sqrt(1 << bits)
    merged = sketches.agg(F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("row_count"),
                          F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    e = F.coalesce("estimate", F.lit(0))
    return merged.select("partitions", F.coalesce("row_count", F.lit(0)).alias("row_count"), e.alias("estimate"),
                         F.floor(e / (1 + error)).alias("low"), F.ceil(e / (1 - error)).alias("high"))
