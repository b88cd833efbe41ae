"""Clustering, compaction and partitioned sinks."""

import pytest
from pyspark.sql import functions as F

from haulwise.sources import layout


def test_ordinals_match_dense_rank(spark):
    rows = [("b", 3), ("a", 10), (None, 3), ("b", 1), ("c", 2), ("a", 2)]
    df = spark.createDataFrame(rows, "s string, n int")
    o = {(r["ci"], r["c0"] if r["ci"] == 0 else r["c1"]): r["ord"]
         for r in layout.ordinals(df, ["s", "n"]).collect()}
    assert [o[(0, v)] for v in (None, "a", "b", "c")] == [0, 1, 2, 3]
    assert [o[(1, v)] for v in (1, 2, 3, 10)] == [0, 1, 2, 3]


def test_interleave_bits(spark):
    df = spark.createDataFrame([(0b11, 0b01)], "a long, b long")
    z = df.select(layout.interleave([F.col("a"), F.col("b")]).alias("z")).first()["z"]
    bits = 63 // 2  # 31 bits each: a's bit goes first at every level
    expect = (1 << (2 * bits - 1 - 2 * (bits - 2))) | (1 << (2 * bits - 1 - 2 * (bits - 1))) \
        | (1 << (2 * bits - 1 - 2 * (bits - 1) - 1))
    assert z == expect


def test_clustered_write_keeps_rows_and_narrows_files(spark, scratch):
    df = spark.range(0, 20000).select(
        (F.col("id") % 3).alias("p"), (F.col("id") * 7919 % 1000).alias("x"),
        (F.col("id") * 104729 % 997).alias("y"), "id")
    path = f"{scratch}/c"
    layout.write_partitioned(df, path, ["p"], ["x", "y"], num_files=24)
    back = spark.read.parquet(path)
    assert sorted(back.select("id").rdd.flatMap(lambda r: r).collect()) == list(range(20000))
    stats = layout.file_stats(spark, path, ["x"]).collect()
    # every file covers a narrow x range compared with the full 0..999
    widths = [r["x_max"] - r["x_min"] for r in stats]
    assert sum(widths) / len(widths) < 700
    # a point filter on a clustering column is pushed to the scan
    plan = back.where(F.col("x") == 5)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(x,5)" in plan


def test_partition_filter_prunes(spark, scratch):
    df = spark.range(0, 1000).select((F.col("id") % 5).cast("string").alias("region"), "id")
    path = f"{scratch}/g"
    layout.write_partitioned(df, path, ["region"])
    q = spark.read.parquet(path).where(F.col("region") == "3")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan and "(region" in plan
    assert q.count() == 200


def test_compact_reduces_files(spark, scratch):
    df = spark.range(0, 5000).select((F.col("id") % 2).alias("p"), "id").repartition(40)
    path = f"{scratch}/k"
    layout.compact(df, path, ["p"], target_rows_per_file=2500)
    files = layout.file_stats(spark, path).count()
    assert files <= 4
    assert spark.read.parquet(path).count() == 5000


def test_hot_value_is_split_across_tasks(spark, scratch):
    # one clustering value holds a third of all rows in a single partition
    n = 30000
    df = spark.range(0, n).select(
        F.lit(1).alias("p"),
        F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id") % 97).alias("x"),
        "id")
    path = f"{scratch}/hot"
    layout.write_partitioned(df, path, ["p"], ["x"], num_files=12)
    stats = layout.file_stats(spark, path, ["x"]).collect()
    assert sum(r["rows"] for r in stats) == n
    assert max(r["rows"] for r in stats) < n // 3  # the hot value is not one file/task
    # compaction of a single hot partition value also spreads over files
    path2 = f"{scratch}/hot2"
    layout.compact(df, path2, ["p"], target_rows_per_file=5000)
    stats2 = layout.file_stats(spark, path2).collect()
    assert len(stats2) >= 5 and max(r["rows"] for r in stats2) < n // 3


def test_dictionary_follows_string_order(spark):
    from haulwise.sources.adapter import dictionary
    vals = ["STANDARD BRASS", "ECONOMY TIN", None, "Zeta", "alpha", "ECONOMY TIN", "éclair", "B"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    codes = {r["t"]: r["code"] for r in dictionary(df, "t", "code").collect()}
    distinct = sorted({v for v in vals if v is not None})
    assert [codes[v] for v in distinct] == list(range(len(distinct)))
    assert min(codes, key=codes.get) == df.agg(F.min("t")).first()[0]


def test_clustered_silver_is_what_readers_get_and_skips_files(spark, sf_small, scratch):
    """The drill-down slice reads fewer files of a clustered Silver: those
    whose range of routes holds the route."""
    from haulwise.operators import analysis
    from haulwise.plans import medallion as M
    from haulwise.sources.adapter import route_days
    from haulwise.sources.tables import layer_path
    M.build_all(spark, scratch, route_days(spark, sf_small), ingestion_ts="2024-01-01 00:00:00")
    path = layer_path(scratch, "silver", "route_days")
    before = sorted(r[0] for r in M.read_silver(spark, scratch).select("route_date_key").collect())
    counts = M.cluster_silver(spark, scratch, num_files=60)
    assert counts["files_before"] > 0 and counts["files_after"] == layout.file_count(spark, path)
    silver = M.read_silver(spark, scratch)
    assert sorted(r[0] for r in silver.select("route_date_key").collect()) == before
    route = analysis.worst_route(silver).first()["route_id"]
    stats = layout.file_stats(spark, path, ["route_id"])
    may_hold = stats.where(F.lit(route).between(F.col("route_id_min"), F.col("route_id_max"))).count()
    assert may_hold < stats.count()
    geo = silver.where(F.col("route_id") == route).select("bu", "area").distinct().first()
    part = analysis.drilldown_slice(silver, geo["bu"], geo["area"], route)
    assert sorted(part.collect()) == sorted(analysis.route_drilldown(silver).collect())
