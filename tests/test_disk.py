"""What a query of many jobs leaves on disk while it runs."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from haulwise.operators import gold, gold_state
from haulwise.plans import catalog as catalog_plans, medallion as M, scenarios
from haulwise.session import DROP_SHUFFLES, checkpoint_root, drop_scratch, scratch_path, shuffles_dropped
from haulwise.sources import layout, upsert as upsert_module
from haulwise.sources.contract import with_ingestion_metadata
from haulwise.sources.keyfilter import KeyFilter
from haulwise.sources.places import Places, place, place_columns, set_of
from haulwise.sources.tables import layer_path


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def scratch_tables(spark):
    root = checkpoint_root(spark).removeprefix("file://").removeprefix("file:")
    return {t for t in glob.glob(f"{root}/haulwise/*") if glob.glob(f"{t}/**/*.*", recursive=True)}


@pytest.fixture()
def no_filter(monkeypatch):
    """As for a batch of too many keys for a filter."""
    monkeypatch.setitem(KeyFilter.__init__.__kwdefaults__, "most_bytes", 0)


def test_jobs_within_leave_no_shuffle_files(spark):
    before, held = spark.conf.get(DROP_SHUFFLES, None), shuffle_files(spark)
    with shuffles_dropped(spark):
        assert spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count().count() == 7
    assert spark.conf.get(DROP_SHUFFLES, None) == before
    end = time.time() + 10  # they are removed behind the job
    while shuffle_files(spark) > held and time.time() < end:
        time.sleep(0.1)
    assert shuffle_files(spark) <= held


def test_queries_are_built_so(spark, sf_small, monkeypatch):
    seen = []
    catalog_plans._q(lambda L: seen.append(L.spark.conf.get(DROP_SHUFFLES)))(spark, sf_small)
    assert seen == ["true"]


def test_only_scratch_tables_are_dropped(spark, scratch):
    with pytest.raises(ValueError):
        drop_scratch(spark, scratch)
    path = scratch_path(spark, "some")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


@pytest.mark.parametrize("name,left", [("history_intervals", 2), ("snapshot_as_of_range", 0)])
def test_tables_that_states_were_made_of_go(spark, sf_small, name, left):
    L = catalog_plans.Layers(spark, sf_small)
    L.sums.count()
    before = scratch_tables(spark)
    out = getattr(scenarios, name)(spark, L.sums, late=L.to_feed)
    assert sum("/keyed-" in t for t in scratch_tables(spark) - before) == left
    assert out.count() > 0


def test_layouts_go_when_their_statistics_are_read(spark, sf_small):
    before = scratch_tables(spark)
    out = catalog_plans.catalog()["route_file_skipping"](spark, sf_small)
    assert not any("/file-skipping-" in t for t in scratch_tables(spark) - before)
    assert out.where("files_plain > 0 and files_clustered > 0").count() == out.count() > 0


def test_landed_rows_and_text_go(spark, sf_small):
    before = scratch_tables(spark)
    out = catalog_plans.catalog()["csv_load_readback"](spark, sf_small)
    new = scratch_tables(spark) - before
    assert not any("/landing-" in t for t in new)
    csv = next(t for t in new if "/csv-load-" in t)
    assert sorted(os.listdir(csv)) == ["_audit", "bronze"] and out.first()["row_count"] > 0


def test_landed_rows_are_dealt_without_a_shuffle(spark, scratch):
    df = spark.range(600).select("id", (F.col("id") % 5).cast("int").alias("a"),
                                 F.when(F.col("id") % 3 > 0, F.col("id") % 3).cast("int").alias("b"), F.col("id").cast("string").alias("s"))
    landed = layout.Landed(df, f"{scratch}/landed", ["a", "b"])
    out = landed.deal(landed.rows, ["a", "b"], layout.AS_IS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and out.columns == df.columns
    assert out.exceptAll(df).count() == 0 and out.count() == 600
    tasks = out.withColumn("t", F.spark_partition_id()).groupBy("t").agg(F.count_distinct(F.struct("a", "b")).alias("n"))
    assert {r["n"] for r in tasks.collect()} == {1}
    assert layout.Landed(df.limit(0), f"{scratch}/none", ["a", "b"]).rows.count() == 0


def test_places_are_exact_and_move_no_row(spark, scratch):
    spark.range(9000).repartition(3).write.parquet(f"{scratch}/t")
    rows = place(spark.read.parquet(f"{scratch}/t"))
    some = rows.where("id % 3 = 1 or id > 8000").select(F.lit("x").alias("g"), *place_columns())
    found = set_of(some, ["g"], F.count(F.lit(1)).alias("n"))
    out = Places(found, "places").flag(rows)
    assert sorted(r["id"] for r in out.where("_taken").collect()) == [i for i in range(9000) if i % 3 == 1 or i > 8000]
    assert out.columns == ["id", "_taken"] and found.agg(F.sum("n")).first()[0] == some.count()
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan
    shuffled = Places(found, "places", most_bytes=0).flag(rows)
    assert shuffled.exceptAll(out).count() == 0 and shuffled.count() == 9000


def test_a_batch_without_a_filter_joins_no_whole_rows(spark, scratch, monkeypatch, no_filter):
    monkeypatch.setattr(upsert_module, "_only", lambda *_: pytest.fail("whole rows joined"))
    schema = "key string, a int, month int"
    rows = lambda ids, a: spark.range(900).where(ids).select(
        F.concat(F.lit("k"), F.col("id")).alias("key"), F.lit(a).alias("a"), (F.col("id") % 3).cast("int").alias("month"))
    rows("id < 600", 1).write.partitionBy("month").parquet(f"{scratch}/t")
    row = upsert_module.upsert(spark, f"{scratch}/t", rows("id % 2 = 0", 2), batch_id="b", key="key", partition_cols=["month"],
                               immutable=("key", "month"), schema=spark.createDataFrame([], schema).schema, compare_ignore=()).first()
    assert (row["inserted"], row["updated"], row["unchanged"]) == (150, 300, 0)
    got = {(r["key"], r["a"], r["month"]) for r in spark.read.schema(schema).parquet(f"{scratch}/t").collect()}
    assert got == {(f"k{i}", 2 if i % 2 == 0 else 1, i % 3) for i in range(900) if i % 2 == 0 or i < 600}


def test_restatement_without_a_filter_joins_no_days_by_key(spark, sf_small, scratch, monkeypatch, no_filter):
    days = catalog_plans.Layers(spark, sf_small).landed.where(F.col("date").between("2001-05-01", "2001-08-15")).cache()
    M.ingest_bronze(spark, scratch, with_ingestion_metadata(days.where("month < 8"), "2024-01-01 00:00:00"), "base")
    thr = M.build_gold_state(spark, scratch)
    layout.write_partitioned(gold_state.gold_of_state(M.read_gold_state(spark, scratch)[0], thr),
                             layer_path(scratch, "gold", "route_months"), gold.GOLD_PARTITIONS)
    plans, real = [], gold_state.contributions
    monkeypatch.setattr(gold_state, "contributions", lambda d, *a: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or real(d, *a))
    batch = days.where("month > 6 and day_of_week <> 'Monday'").withColumns({
        "gross_margin_pct": F.col("gross_margin_pct") - 60, "total_cost": F.col("total_cost") * 1.1})
    out = M.restate(spark, scratch, with_ingestion_metadata(batch, "2024-02-01 00:00:00"), "restated")
    joins = [line for p in plans for line in p.splitlines() if "Join" in line]
    assert joins and not any("route_date_key" in line for line in joins)
    now = M.read_bronze(spark, scratch)
    assert out["threshold"] != thr and out["audit"]["updated"] > 0 and out["audit"]["inserted"] > 0
    want = gold_state.gold_of_state(gold_state.gold_state(now, out["threshold"]), out["threshold"])
    got = M.read_gold(spark, scratch)
    told = lambda df: sorted(tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r) for r in df.select(*sorted(want.columns)).collect())
    assert told(got) == told(want)
