"""Plans that read the feed more than once derive it once, and shuffle and
store it in its narrow form."""

import json

import pytest
from pyspark.sql import functions as F

from haulwise.plans import catalog as catalog_plans
from haulwise.plans.catalog import Layers, catalog
from haulwise.session import cut_lineage
from haulwise.sources import layout
from haulwise.sources.adapter import SUM_COLUMNS, feed_of, route_day_sums


@pytest.mark.parametrize("name", ["gold_sums", "gold_ratios", "route_drilldown", "route_windows", "persistent_routes",
                                  "yearly_trend", "trend_direction", "pruned_slice", "star_slice_region_quarter",
                                  "compacted_rows", "clustered_rows", "snapshot_diff", "evolved_rows"])
def test_feed_is_derived_once(spark, sf_small, monkeypatch, name):
    whole = route_day_sums(spark, sf_small)
    derived = []

    def once(*_):
        derived.append(name)
        return whole

    monkeypatch.setattr(catalog_plans, "route_day_sums", once)
    monkeypatch.setattr(catalog_plans, "route_days", lambda *_: pytest.fail("derived apart from the stored form"))
    out = catalog()[name](spark, sf_small)
    assert derived == [name]
    assert "lineitem" not in out._jdf.queryExecution().executedPlan().toString()


def test_sums_are_what_the_feed_needs(spark, sf_small):
    sums = route_day_sums(spark, sf_small)
    assert sorted(sums.columns) == sorted(SUM_COLUMNS)
    kept = feed_of(sums.limit(3).withColumn("extra", F.lit(1)))
    assert kept.columns[-1] == "extra" and len(kept.columns) == 40



def test_silver_is_dealt_narrow_and_widened_after(spark, sf_small):
    L = Layers(spark, sf_small)
    out = layout.clustered(L.routed, ["year", "region"], ["bu", "area", "route_id"], 4, L.to_silver)
    plan = json.loads(out._jdf.queryExecution().optimizedPlan().toJSON())
    kinds = [n["class"].rsplit(".", 1)[1] for n in plan]
    assert kinds.index("Project") < kinds.index("RepartitionByExpression")
    moved = plan[kinds.index("RepartitionByExpression"):]
    assert "underperformance_reason" not in json.dumps(moved)
    assert sorted(out.columns) == sorted(L.silver.columns)
    assert out.exceptAll(L.silver).count() == 0 and out.count() == L.silver.count()


def test_late_write_equals_a_plain_one(spark, scratch):
    narrow = cut_lineage(spark.range(900).select("id", (F.col("id") % 3).alias("a")), "narrow")
    late = layout.Late(lambda rows: rows.select("id", (F.col("a") + 1).alias("p"), (F.col("id") * 2).alias("twice")), {"p": F.col("a") + 1})
    want = sorted(tuple(r) for r in late.widen(narrow).select("id", "twice", "p").collect())
    for i, args in enumerate(({}, {"num_files": 5}, {"zorder_cols": ["id"], "num_files": 5}, {"max_records_per_file": 100})):
        layout.write_partitioned(narrow, f"{scratch}/{i}", ["p"], late=late, **args)
        back = spark.read.parquet(f"{scratch}/{i}").select("id", "twice", "p")
        assert sorted(tuple(r) for r in back.collect()) == want


def test_history_in_buckets_moves_no_wide_row(spark, sf_small):
    """The keys' rows are compared where they are stored."""
    from haulwise.plans import scenarios
    from haulwise.sources import snapshots
    L = Layers(spark, sf_small)
    scenario = scenarios.Restatement(spark, L.sums, L.to_feed)
    history = scenario.history(rerun=True)
    plain = scenarios.Restatement(spark, L.landed)
    loads = plain.base().unionByName(plain.batch()).unionByName(plain.batch(scenarios.RERUN_TS))
    assert history.exceptAll(loads).count() == 0 and history.count() == loads.count()
    states = snapshots.intervals(history, ["route_date_key"])
    old, new = (snapshots.as_of(history, t, ["route_date_key"]) for t in (scenarios.BASE_TS, scenarios.RESTATE_TS))
    for df in (states, old, snapshots.diff(old, new, ["route_date_key"])):
        df.count()
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    want = snapshots.intervals(cut_lineage(loads, "loads"), ["route_date_key"])
    assert states.exceptAll(want).count() == 0 and states.count() == want.count()
