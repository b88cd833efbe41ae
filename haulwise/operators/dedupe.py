"""Keep-latest deduplication on a natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_latest(df: DataFrame, keys: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    Same result as ``row_number() over (partition by keys order by order
    desc) = 1`` with nulls ordered lowest. The order columns, then all others,
    form one struct, and its maximum per key is the row: one scan and one
    shuffle, partial on the map side, so a key holding a third of all rows is
    cut to one row per map task before the shuffle instead of landing whole
    in one task. Rows that tie on ``order`` are told apart by the remaining
    columns, in the frame's order.
    """
    keys, order = list(keys), list(order)
    fields = order + [c for c in df.columns if c not in keys and c not in order]
    return (
        df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in fields])).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])
    )
