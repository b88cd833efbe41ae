"""Stored sketches, the interval join, and what clustering lets a reader skip."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from haulwise.functions import sketches
from haulwise.functions.quantile import discrete_quantiles
from haulwise.operators.interval_join import containing
from haulwise.sources import layout


@pytest.mark.parametrize("seed", range(3))
def test_points_in_intervals(spark, seed):
    rng = random.Random(seed)
    top = (7, 64, 1000)[seed]
    points = [(k, rng.randint(0, top) if rng.random() > 0.05 else None) for k in range(120)]
    intervals = [(k, *sorted((rng.randint(0, top), rng.randint(0, top)))) for k in range(60)]
    intervals += [(100, 0, top), (101, 3, 2), (102, None, 5), (103, 1, None), (104, 5, 5), (105, -3, 4)]
    got = containing(spark.createDataFrame(points, "p int, x int"), "x", spark.createDataFrame(intervals, "i int, lo bigint, hi bigint"),
                     "lo", "hi").select("p", "i").collect()
    want = {(p, i) for p, x in points for i, lo, hi in intervals
            if None not in (x, lo, hi) and lo >= 0 and lo <= x <= hi}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_interval_join_has_no_product_and_takes_empty_sides(spark):
    points, none = spark.range(50).withColumnRenamed("id", "x"), spark.createDataFrame([], "lo bigint, hi bigint")
    out = containing(points, "x", spark.createDataFrame([(1, 4)], "lo bigint, hi bigint"), "lo", "hi")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sorted(r["x"] for r in out.collect()) == [1, 2, 3, 4]
    assert containing(points, "x", none, "lo", "hi").count() == 0
    assert containing(points.limit(0), "x", spark.createDataFrame([(1, 4)], "lo bigint, hi bigint"), "lo", "hi").count() == 0


def test_files_touched_equals_duckdb_over_the_written_files(spark, scratch):
    df = spark.range(6000).select((F.col("id") % 2).cast("int").alias("p"), F.concat(F.lit("b"), F.col("id") % 5).alias("b"),
                                  F.format_string("r%03d", F.col("id") * 7 % 83).alias("r"), "id")
    layout.write_partitioned(df, f"{scratch}/plain", ["p"], max_records_per_file=400)
    files = layout.file_count(spark, f"{scratch}/plain")
    layout.write_partitioned(df, f"{scratch}/z", ["p"], ["b", "r"], num_files=files)
    wanted = df.select("b", "r").distinct()
    total = {}
    for name in ("plain", "z"):
        stats = layout.file_stats(spark, f"{scratch}/{name}", ["b", "r"])
        got = {(r["b"], r["r"]): r["files"] for r in layout.files_touched(wanted, stats, ["b", "r"], "r").collect()}
        want = duckdb.sql(f"""
            WITH rows AS (SELECT * FROM read_parquet('{scratch}/{name}/*/*.parquet', filename = true)),
            stats AS (SELECT filename, min(b) AS bl, max(b) AS bh, min(r) AS rl, max(r) AS rh FROM rows GROUP BY filename)
            SELECT w.b, w.r, count(*) FROM (SELECT DISTINCT b, r FROM rows) w
            JOIN stats s ON w.b BETWEEN bl AND bh AND w.r BETWEEN rl AND rh GROUP BY ALL""").fetchall()
        assert got == {(b, r): n for b, r, n in want}
        total[name] = sum(got.values())
    assert total["z"] < 0.6 * total["plain"]


def _values(spark):
    return spark.range(30_000).select((F.col("id") % 12).alias("month"), F.when(F.col("id") % 50 > 0, F.pmod(
        F.xxhash64("id"), F.lit(5000)) / 7.0).alias("m"), F.concat(F.lit("k"), F.col("id") % 9000).alias("k"))


def test_exact_quantiles_from_sketches(spark):
    df, qs = _values(spark), [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    held = sketches.quantile_sketches(df, "m", ["month"])
    assert held.count() == 12
    want = discrete_quantiles(df, "m", qs)
    assert sketches.exact_quantiles(df, "m", qs, held) == want
    # a sketch of other rows brackets wrongly, and the counts put it right
    wrong = sketches.quantile_sketches(df.withColumn("m", F.col("m") * 0 + F.col("month")), "m", ["month"])
    assert sketches.exact_quantiles(df, "m", qs, wrong) == want
    none = df.limit(0)
    assert sketches.threshold_from_sketches(none, "m", 0.1, sketches.quantile_sketches(none, "m", ["month"])) == 10.0


def test_changed_partitions_replace_their_sketches(spark):
    df = _values(spark)
    changed = df.withColumn("m", F.when(F.col("month") == 3, F.col("m") - 4000).otherwise(F.col("m")))
    new = sketches.quantile_sketches(changed.where("month = 3"), "m", ["month"])
    held = sketches.replace_partitions(sketches.quantile_sketches(df, "m", ["month"]), new, ["month"])
    assert held.count() == 12
    assert sketches.exact_quantiles(changed, "m", [0.05, 0.5], held) == discrete_quantiles(changed, "m", [0.05, 0.5])


def test_distinct_estimate_is_within_its_bounds(spark):
    df = _values(spark)
    row = sketches.distinct_estimate(sketches.distinct_sketches(df, "k", ["month"])).first()
    assert row["partitions"] == 12 and row["row_count"] == 30_000
    assert row["low"] <= 9000 <= row["high"] and row["high"] - row["low"] < 0.06 * 9000
    empty = sketches.distinct_estimate(sketches.distinct_sketches(df.limit(0), "k", ["month"])).first()
    assert tuple(empty) == (0, 0, 0, 0, 0)
