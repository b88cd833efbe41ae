"""CSV contract enforcement and planted data-quality defects."""

import os

import pytest
from pyspark.sql import functions as F

from haulwise.operators.quality import dq_summary, duplicate_key_summary, null_counts
from haulwise.sources.adapter import route_days
from haulwise.sources.contract import (
    SOURCE_COLUMNS, SOURCE_SCHEMA, read_source, schema_check, with_ingestion_metadata,
)

HEADER = ",".join(SOURCE_COLUMNS)
GOOD = ("RTE-0001_2024-01-02,2024-01-02,2024,1,Q1,Tuesday,WEST,BU1,A1,RTE-0001,Glass,Retail,"
        "1,1,10,9,1,5.0,2.0,4.5,1.5,1.0,10.0,100.0,20.0,10.0,30.0,5.0,5.0,70.0,80.0,30.0,30.0,"
        "4.5,4.75,15,0,0,None")


def _write(scratch, name, text):
    d = os.path.join(scratch, name)
    os.makedirs(d)
    with open(os.path.join(d, "f.csv"), "w") as f:
        f.write(text)
    return d


def test_good_csv_reads_with_metadata(spark, scratch):
    df = with_ingestion_metadata(read_source(spark, _write(scratch, "ok", HEADER + "\n" + GOOD + "\n")),
                                 "2024-01-01 00:00:00")
    r = df.first()
    assert r["source_file"] == "f.csv" and r["incident_type"] == "None"
    assert r["total_revenue"] == 100.0 and str(r["date"]) == "2024-01-02"


@pytest.mark.parametrize("case,header,row", [
    ("renamed", HEADER.replace("total_revenue", "revenue"), GOOD),
    ("extra", HEADER + ",extra", GOOD + ",1"),
    ("missing", HEADER.rsplit(",", 1)[0], GOOD.rsplit(",", 1)[0]),
    ("na_double", HEADER, GOOD.replace(",100.0,", ",N/A,")),
    ("bad_date", HEADER, GOOD.replace(",2024-01-02,", ",2024-13-02,")),
])
def test_malformed_csv_fails_fast(spark, scratch, case, header, row):
    path = _write(scratch, case, header + "\n" + row + "\n")
    with pytest.raises(Exception):
        read_source(spark, path).collect()


def test_empty_double_loads_as_null_and_is_counted(spark, scratch):
    row = GOOD.replace(",100.0,", ",,")
    df = read_source(spark, _write(scratch, "empty", HEADER + "\n" + row + "\n"))
    assert df.first()["total_revenue"] is None
    nulls = {r["column"]: r["null_count"] for r in null_counts(df, offenders_only=True).collect()}
    assert nulls == {"total_revenue": 1}


def test_schema_check_reports_drift(spark):
    df = spark.createDataFrame([(1, "x")], "route_date_key int, extra string")
    out = {r["column"]: r["status"] for r in schema_check(df, SOURCE_SCHEMA).collect()}
    assert out["route_date_key"] == "type_mismatch"
    assert out["date"] == "missing" and out["extra"] == "unexpected"


def test_planted_defects_are_counted(spark, sf_small):
    feed = route_days(spark, sf_small).where(F.col("date") < "1995-03-01").cache()
    n = feed.count()
    k = feed.limit(4).collect()
    keys = [r["route_date_key"] for r in k]
    bad = (feed
           .withColumn("completed_stops", F.when(F.col("route_date_key") == keys[0],
                                                 F.col("total_stops") + 1).otherwise(F.col("completed_stops")))
           .withColumn("total_revenue", F.when(F.col("route_date_key") == keys[1], F.lit(-5.0))
                       .otherwise(F.col("total_revenue")))
           .withColumn("incident_flag", F.when(F.col("route_date_key") == keys[2], F.lit(1))
                       .otherwise(F.col("incident_flag")))
           .withColumn("bu", F.when(F.col("route_date_key") == keys[3], F.lit(None))
                       .otherwise(F.col("bu"))))
    bad = bad.unionByName(feed.where(F.col("route_date_key") == keys[0]))
    s = dq_summary(bad).first()
    base = dq_summary(feed).first()
    assert s["row_count"] == n + 1
    assert s["completed_gt_total"] == base["completed_gt_total"] + 1
    assert s["negative_total_revenue"] == base["negative_total_revenue"] + 1
    extra_mismatch = 1 if k[2]["incident_flag"] == 0 else 0
    assert s["flag_type_mismatch"] == base["flag_type_mismatch"] + extra_mismatch
    nulls = {r["column"]: r["null_count"] for r in null_counts(bad, offenders_only=True).collect()}
    assert nulls == {"bu": 1}
    d = duplicate_key_summary(bad).first()
    assert (d["row_count"], d["distinct_keys"], d["duplicate_keys"]) == (n + 1, n, 1)


def test_read_layer_pins_partition_types(spark, scratch):
    from haulwise.sources.tables import read_layer
    df = spark.createDataFrame([("01", 1.5), ("10", 2.5)], "code string, v double")
    df.write.partitionBy("code").parquet(f"{scratch}/l/t")
    inferred = spark.read.parquet(f"{scratch}/l/t")
    assert dict(inferred.dtypes)["code"] == "int"  # what a plain read does
    pinned = read_layer(spark, scratch, "l", "t", schema=df.schema)
    assert pinned.columns == ["code", "v"] and dict(pinned.dtypes)["code"] == "string"
    assert sorted(r["code"] for r in pinned.collect()) == ["01", "10"]
