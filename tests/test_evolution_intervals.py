"""Loads of changing schema, validity intervals, and all levels in one pass."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType, StringType, TimestampNTZType,
)

from haulwise.operators import analysis
from haulwise.sources import evolution, snapshots


@pytest.mark.parametrize("a,b,both", [
    (IntegerType(), LongType(), LongType()), (IntegerType(), DoubleType(), DoubleType()), (LongType(), DoubleType(), None),
    (FloatType(), DoubleType(), DoubleType()), (IntegerType(), DecimalType(12, 2), DecimalType(12, 2)),
    (LongType(), DecimalType(12, 2), DecimalType(22, 2)), (DecimalType(10, 4), DecimalType(12, 2), DecimalType(14, 4)),
    (DecimalType(38, 0), DecimalType(10, 5), None), (DateType(), TimestampNTZType(), TimestampNTZType()),
    (StringType(), IntegerType(), None), (BooleanType(), BooleanType(), BooleanType()), (NullType(), StringType(), StringType())])
def test_wider(a, b, both):
    assert evolution.wider(a, b) == both and evolution.wider(b, a) == both


def test_merged_read_fills_and_widens(spark, scratch):
    evolution.write_load(spark.createDataFrame([(1, 2, "x")], "k int, n int, s string"), scratch, "a", "2024-01-01")
    evolution.write_load(spark.createDataFrame([(2, 1 << 40, 0.5)], "k int, n bigint, d double"), scratch, "b", "2024-01-02")
    evolution.write_load(spark.createDataFrame([(3, 4, "y")], "k int, n int, s string"), scratch, "c", "2024-01-03")
    got = evolution.read_merged(spark, scratch)
    assert got.dtypes == [("load_id", "string"), ("k", "int"), ("n", "bigint"), ("s", "string"), ("d", "double")]
    assert sorted(got.collect()) == [("a", 1, 2, "x", None), ("b", 2, 1 << 40, None, 0.5), ("c", 3, 4, "y", None)]
    plan = got.where("n = 4").select("k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ReadSchema: struct<k:int,n:") == 2  # loads of equal schema share a scan
    changes = {(r["load_id"], r["column"], r["change"], r["non_null"]) for r in evolution.schema_changes(spark, scratch).collect()}
    assert changes == {("a", "n", "widened", 1), ("c", "n", "widened", 1), ("a", "d", "missing", 0), ("b", "s", "missing", 0),
                       ("b", "d", "added", 1), ("c", "d", "missing", 0)}


def test_types_that_do_not_meet_are_refused(spark, scratch):
    evolution.write_load(spark.createDataFrame([(1,)], "k int"), scratch, "a", "2024-01-01")
    evolution.write_load(spark.createDataFrame([("1",)], "k string"), scratch, "b", "2024-01-02")
    with pytest.raises(ValueError, match="'k' is int in one load and string"):
        evolution.read_merged(spark, scratch)


SCHEMA = "k string, v int, w string, ingestion_ts timestamp, source_file string"


def _load(spark, day, rows):
    return spark.createDataFrame([(k, v, w, None, f"f{day}") for k, v, w in rows], SCHEMA).withColumn(
        "ingestion_ts", F.lit(f"2024-01-{day:02} 00:00:00").cast("timestamp"))


def _states(df):
    return [(r["k"], r["v"], r["w"], r["valid_from"].day, r["valid_to"].day if r["valid_to"] else 0) for r in df.collect()]


def test_intervals_of_a_history_and_load_by_load(spark):
    loads = [_load(spark, 1, [("a", 1, None), ("b", 2, "x"), ("c", 3, "y")]),
             _load(spark, 2, [("a", 1, None), ("b", None, "x"), ("d", 4, "z")]),  # a unchanged, b to null
             _load(spark, 3, [("b", 2, "x"), ("a", 1, "now")]), _load(spark, 4, [])]
    want = [("a", 1, None, 1, 3), ("a", 1, "now", 3, 0), ("b", None, "x", 2, 3), ("b", 2, "x", 1, 2), ("b", 2, "x", 3, 0),
            ("c", 3, "y", 1, 0), ("d", 4, "z", 2, 0)]
    history = loads[0]
    states = snapshots.intervals(loads[0], ["k"])
    for load in loads[1:]:
        history, states = history.unionByName(load), snapshots.extend_intervals(states, load, "k")
    assert sorted(_states(states), key=str) == sorted(want, key=str)
    whole = snapshots.intervals(history, ["k"])
    assert sorted(_states(whole), key=str) == sorted(want, key=str)
    for day in (1, 2, 3, 4):
        at = f"2024-01-{day:02} 12:00:00"
        old = sorted(((r["k"], r["v"], r["w"]) for r in snapshots.as_of(history, at, ["k"]).collect()), key=str)
        assert old == sorted(((r["k"], r["v"], r["w"]) for r in snapshots.as_of_intervals(whole, at).collect()), key=str)


def test_as_of_intervals_is_a_filter(spark, scratch):
    snapshots.intervals(_load(spark, 1, [("a", 1, "x")]), ["k"]).write.parquet(f"{scratch}/i")
    plan = snapshots.as_of_intervals(spark.read.parquet(f"{scratch}/i"), "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan and "PushedFilters" in plan and "LessThanOrEqual(valid_from" in plan


def test_all_levels_read_silver_once_and_equal_each_level(spark, sf_small):
    from haulwise.plans.catalog import Layers
    silver = Layers(spark, sf_small).silver.cache()
    every = analysis.hier_all_levels(silver)
    rows = {(r["level"], r["key"]): tuple(r)[2:] for r in every.collect()}
    for c in analysis.LEVELS:
        one = {(c, r[c]): tuple(r)[1:] for r in analysis.hier(silver, c).collect()}
        assert {k: v for k, v in rows.items() if k[0] == c} == one
    assert rows[("fleet", None)][0] == silver.count()
    assert every._jdf.queryExecution().sparkPlan().toString().count("InMemoryTableScan") == 1
    silver.unpersist()
