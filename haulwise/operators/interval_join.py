"""Points joined with the intervals that hold them, as an equi-join.

Numbers from 0 are leaves of a binary tree. A point is in one node of every
level; an interval is the union of at most two nodes a level, which do not
overlap. Point and interval share exactly one of those nodes if the point is
inside, and none otherwise, so a join on (level, node) gives each pair once and
no others: no cross join, and no filter on a product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _bits(points: DataFrame, point: str, intervals: DataFrame, high: str) -> int:
    top = max(points.agg(F.max(point)).first()[0] or 0, intervals.agg(F.max(high)).first()[0] or 0)
    return int(top).bit_length()


def containing(points: DataFrame, point: str, intervals: DataFrame, low: str, high: str) -> DataFrame:
    """``points`` x ``intervals`` where ``low <= point <= high`` (bigints from
    0; rows with a null in any of them, and intervals that end before they
    begin, hold nothing). Columns of both, whose names must differ."""
    bits = _bits(points, point, intervals, high)
    asked = (points.where(F.col(point) >= 0).withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(bits))))
             .withColumn("_node", F.call_function("shiftright", F.col(point).cast("bigint"), F.col("_level"))))
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_level"))
    first = F.call_function("shiftright", F.col(low).cast("bigint") + size - 1, F.col("_level"))
    end = F.call_function("shiftright", F.col(high).cast("bigint") + 1, F.col("_level"))
    odd = lambda c: c.bitwiseAND(F.lit(1)) == 1
    cover = (intervals.where((F.col(low) >= 0) & (F.col(low) <= F.col(high)))
             .withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(bits))))
             .withColumns({"_first": first, "_end": end}).where("_first < _end")
             .withColumn("_node", F.explode(F.array_compact(F.array(
                 F.when(odd(F.col("_first")), F.col("_first")), F.when(odd(F.col("_end")), F.col("_end") - 1)))))
             .drop("_first", "_end"))
    return asked.join(cover, ["_level", "_node"]).drop("_level", "_node")
