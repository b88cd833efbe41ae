"""C28-C30 on the stream: each route's totals as keyed state.

A micro-batch brings route-days, new ones and restated ones. The state of a
route holds what each of its days has put into the totals, so a restated day
first takes its old part back and then adds its new one; no other day is read
again. What comes out after a micro-batch are the routes that it touched, with
the same columns, to the bit, as the batch rollup over the latest row of every
day gives them.

The session needs the RocksDB state store (``STATE_STORE``). The threshold is
fixed for a run of the stream; a new one starts from a new checkpoint.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from haulwise.operators.dedupe import dedupe_latest
from haulwise.operators.silver import PERSISTENT_DAY_SHARE
from haulwise.session import scratch_path

STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
MEASURES = ["gross_profit", "total_revenue"]
# of each measure: millionths, what they leave over, how many values
PART = ", ".join(f"{m}_millionths bigint, {m}_rest double, {m}_n bigint" for m in MEASURES) + ", under bigint, told bigint"
RULE = ("route_id string, days bigint, route_weighted_margin_pct double, route_pct_days_under double, "
        "route_persistent_underperformer boolean")
MILLIONTH = Decimal("0.000001")


def _known(v) -> bool:
    return v is not None and v == v


def day_part(row: dict, threshold: float) -> tuple:
    """What a day adds: the exact parts of its measures, as in ``exact_sum``,
    and its flag."""
    out: list = []
    for m in MEASURES:
        v = row[m]
        if not _known(v):
            out += [0, 0.0, 0]
        else:
            exact = Decimal(repr(float(v))).quantize(MILLIONTH, ROUND_HALF_UP)
            out += [int(exact / MILLIONTH), float(v) - float(exact), 1]
    margin = row["gross_margin_pct"]
    return (*out, int(_known(margin) and margin < threshold), int(_known(margin)))


def rule_row(route, days: int, total: tuple, threshold: float) -> dict:
    """The rollup's columns from the totals of a route."""
    profit, revenue = (float(Decimal(total[k]) * MILLIONTH) + total[k + 1] if total[k + 2] else None for k in (0, 3))
    margin = profit / revenue * 100 if profit is not None and revenue else None
    share = total[6] / days if total[7] and days else None
    weak = None if margin is None else margin < threshold
    often = None if share is None else share >= PERSISTENT_DAY_SHARE
    # null or true is true, null or false is null
    either = True if weak or often else None if weak is None or often is None else False
    return {"route_id": route, "days": days, "route_weighted_margin_pct": margin, "route_pct_days_under": share,
            "route_persistent_underperformer": either}


class RouteRule(StatefulProcessor):
    def __init__(self, threshold: float) -> None:
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getMapState("days", "route_date_key string", PART)
        self.total = handle.getValueState("total", f"days bigint, {PART}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        now = self.total.get() if self.total.exists() else (0,) * 9
        days, total = now[0], list(now[1:])
        latest: dict[str, dict] = {}
        for frame in rows:
            for row in frame.to_dict("records"):
                held = latest.get(row["route_date_key"])
                if held is None or row["load_order"] >= held["load_order"]:
                    latest[row["route_date_key"]] = row
        for day, row in latest.items():
            part = day_part(row, self.threshold)
            if self.days.containsKey((day,)):
                total = [t - old for t, old in zip(total, self.days.getValue((day,)), strict=True)]
            else:
                days += 1
            total = [t + new for t, new in zip(total, part, strict=True)]
            self.days.updateValue((day,), part)
        self.total.update((days, *total))
        yield pd.DataFrame([rule_row(key[0], days, tuple(total), self.threshold)])

    def close(self) -> None:
        pass


def route_rule(stream: DataFrame, threshold: float, load_order: str = "ingestion_ts") -> DataFrame:
    """The routes that a micro-batch of route-days touches, as they are after
    it. Of two rows of a day in one micro-batch the one of the later
    ``load_order`` counts."""
    days = stream.select("route_id", "route_date_key", *MEASURES, "gross_margin_pct",
                         F.col(load_order).cast("string").alias("load_order")).fillna({"load_order": ""})
    return days.groupBy("route_id").transformWithStateInPandas(RouteRule(threshold), RULE, "Update", "None")


def start_route_rule(spark: SparkSession, stream: DataFrame, out: str, threshold: float, checkpoint: str | None = None,
                     load_order: str = "ingestion_ts") -> StreamingQuery:
    """Runs over what is there and stops. Every micro-batch is a folder of its
    own under ``out``, which a replay after a failure writes again."""

    def write(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(out, f"epoch={epoch}"))

    return (route_rule(stream, threshold, load_order).writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint or scratch_path(spark, "route-rule-checkpoint"))
            .trigger(availableNow=True).start())


def read_route_rule(spark: SparkSession, out: str) -> DataFrame:
    """Every route as its last micro-batch left it."""
    rows = spark.read.schema(f"{RULE}, epoch bigint").parquet(out)
    return dedupe_latest(rows, ["route_id"], ["epoch"]).drop("epoch")
