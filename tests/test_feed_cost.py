"""What makes the feed cheap to derive and widen."""

from pyspark.sql import functions as F

from haulwise.plans.catalog import Layers
from haulwise.sources.adapter import day_text, route_days, route_id, weekday


def test_key_texts_are_the_formatters(spark):
    ks = spark.createDataFrame([(k,) for k in (0, 7, 9999, 10_000, 123_456_789_012, -5, -12_345, None)], "k bigint")
    got = ks.select(route_id(F.col("k")).alias("a"), F.concat(F.lit("RTE-"), F.format_string("%04d", "k")).alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]
    days = spark.sql("select explode(sequence(date'1995-02-26', date'1995-03-08')) d union all select make_date(y, 3, 1) "
                     "from values (-44), (0), (1), (9999), (10000) t(y) union all select null")
    got = days.select(day_text(F.col("d")).alias("a"), F.date_format("d", "yyyy-MM-dd").alias("b"),
                      weekday(F.col("d")).alias("c"), F.date_format("d", "EEEE").alias("e")).collect()
    assert len(got) == 17 and all(r["a"] == r["b"] and r["c"] == r["e"] for r in got)


def test_a_null_date_has_no_weekday(spark, scratch):
    spark.sql("select date'2001-01-06' d union all select null").write.parquet(f"{scratch}/d")
    rows = spark.read.parquet(f"{scratch}/d").select("d", weekday(F.col("d")).alias("w")).collect()
    assert {r["w"] for r in rows if r["d"] is None} == {None} and len(rows) == 2


def test_lines_are_not_sorted_for_their_joins(spark, sf_small):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = route_days(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines = [x for x in plan.splitlines() if "Join" in x and ("l_partkey" in x or "l_orderkey" in x)]
    assert lines and all("ShuffledHashJoin" in x for x in lines)


def test_margins_are_stored_for_the_threshold(spark, sf_small, monkeypatch):
    from haulwise.functions import quantile
    kept, real = [], quantile.cut_lineage
    monkeypatch.setattr(quantile, "cut_lineage", lambda df, name: kept.append(df.columns) or real(df, name))
    L = Layers(spark, sf_small)
    assert L.threshold == quantile.compute_underperformance_threshold(L.landed, materialize=False)
    assert kept == [["m"]]
