"""Keyed state on the stream: after every micro-batch the routes are what the
batch rollup makes of the latest rows."""

import pytest
from pyspark.sql import functions as F

from haulwise.operators.silver import flag_days, route_rollup, silver_base
from haulwise.sources.adapter import route_days
from haulwise.sources.contract import with_ingestion_metadata
from haulwise.streaming import route_rule as R

THRESHOLD = 30.0


@pytest.fixture()
def state_store(spark):
    for k, v in R.STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k in R.STATE_STORE:
        spark.conf.unset(k)


def batch_rule(days):
    rows = route_rollup(flag_days(silver_base(days), THRESHOLD), THRESHOLD)
    return {r["route_id"]: (r["route_weighted_margin_pct"], r["route_pct_days_under"], r["route_persistent_underperformer"])
            for r in rows.collect()}


def test_state_follows_restated_days(spark, sf_small, scratch, state_store):
    feed = route_days(spark, sf_small).where(F.col("date").between("2001-05-01", "2001-07-31")).cache()
    first = with_ingestion_metadata(feed.where("month < 7"), "2024-01-01 00:00:00")
    restated = with_ingestion_metadata(feed.where("month = 6").withColumns({
        "gross_profit": F.col("gross_profit") * 0.37, "gross_margin_pct": F.col("gross_margin_pct") - 45}), "2024-02-01 00:00:00")
    late = with_ingestion_metadata(feed.where("month = 7"), "2024-02-01 00:00:00")
    lost = with_ingestion_metadata(feed.where("date = '2001-05-07'").withColumns({
        "gross_margin_pct": F.lit(None).cast("double"), "total_revenue": F.lit(None).cast("double")}), "2024-03-01 00:00:00")
    loads = [first, restated.unionByName(late), lost]
    landing, out, checkpoint = f"{scratch}/landing", f"{scratch}/out", f"{scratch}/checkpoint"
    now = None
    for load in loads:
        load.coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(first.schema).parquet(landing)
        R.start_route_rule(spark, stream, out, THRESHOLD, checkpoint).awaitTermination()
        keys = load.select("route_date_key")
        now = load if now is None else now.join(keys, "route_date_key", "left_anti").unionByName(load)
        got = {r["route_id"]: (r["route_weighted_margin_pct"], r["route_pct_days_under"], r["route_persistent_underperformer"])
               for r in R.read_route_rule(spark, out).collect()}
        want = batch_rule(now.drop("ingestion_ts"))
        assert set(got) == set(want)
        for route, values in want.items():
            assert got[route][1:] == values[1:]
            assert got[route][0] == pytest.approx(values[0], rel=1e-13)
    assert {r["days"] for r in R.read_route_rule(spark, out).collect()} == {
        r["n"] for r in now.groupBy("route_id").agg(F.count("*").alias("n")).collect()}
    feed.unpersist()


def test_parts_and_rule_of_odd_values():
    nothing = {"gross_profit": None, "total_revenue": float("nan"), "gross_margin_pct": None}
    assert R.day_part(nothing, 10.0) == (0, 0.0, 0, 0, 0.0, 0, 0, 0)
    part = R.day_part({"gross_profit": -1.5, "total_revenue": 0.0, "gross_margin_pct": 10.0}, 10.0)
    assert part == (-1_500_000, 0.0, 1, 0, 0.0, 1, 0, 1)
    row = R.rule_row("r", 1, part, 10.0)
    assert row["route_weighted_margin_pct"] is None and row["route_pct_days_under"] == 0.0
    assert row["route_persistent_underperformer"] is None
    assert R.rule_row("r", 1, R.day_part({"gross_profit": 1.0, "total_revenue": 2.0, "gross_margin_pct": 50.0}, 60.0), 60.0)[
        "route_persistent_underperformer"] is True
