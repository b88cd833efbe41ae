"""File-stream ingest: new CSV drops are upserted once each, restated days
update in place, and a restart with the same checkpoint skips old files."""

import datetime as dt
import os

from pyspark.sql import functions as F

from haulwise.plans.medallion import read_bronze
from haulwise.plans.scenarios import restatement_batch
from haulwise.sources.adapter import route_days
from haulwise.sources.contract import SOURCE_COLUMNS
from haulwise.sources.upsert import audit_path_for, read_audit
from haulwise.streaming.ingest import start_bronze_ingest


def _drop(df, path):
    df.coalesce(1).write.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def test_stream_ingest_and_restatement(spark, sf_small, scratch):
    feed = route_days(spark, sf_small)
    landing, root, ckpt = (os.path.join(scratch, d) for d in ("landing", "root", "ckpt"))
    os.makedirs(landing)
    early = feed.where(F.col("date") < "2001-07-01")
    _drop(early, os.path.join(landing, "day1"))
    # the stream reads files in the landing folder itself
    staged = os.path.join(landing, "day1")
    for f in os.listdir(staged):
        if f.endswith(".csv"):
            os.rename(os.path.join(staged, f), os.path.join(landing, "drop-1.csv"))
    q = start_bronze_ingest(spark, landing, root, ckpt)
    q.awaitTermination()
    assert read_bronze(spark, root).count() == early.count()

    late = restatement_batch(feed, dt.date(2001, 7, 1), dt.date(2001, 1, 1)).select(*SOURCE_COLUMNS)
    _drop(late, os.path.join(scratch, "day2"))
    for f in os.listdir(os.path.join(scratch, "day2")):
        if f.endswith(".csv"):
            os.rename(os.path.join(scratch, "day2", f), os.path.join(landing, "drop-2.csv"))
    q = start_bronze_ingest(spark, landing, root, ckpt)
    q.awaitTermination()
    bronze = read_bronze(spark, root)
    assert bronze.count() == feed.count()
    assert bronze.select("route_date_key").distinct().count() == feed.count()
    audit = {r["batch_id"]: r for r in read_audit(spark, audit_path_for(root, "route_days")).collect()}
    assert len(audit) == 2  # one micro-batch per run, the first file not re-read
    assert {k.rsplit("-", 1)[1] for k in audit} == {"0", "1"}
    second = [r for k, r in audit.items() if k.endswith("-1")][0]
    restated = late.where(F.col("date") < "2001-07-01").count()
    assert second["updated"] == restated
    assert second["inserted"] == late.count() - restated
    files = {r[0] for r in bronze.select("source_file").distinct().collect()}
    assert files == {"drop-1.csv", "drop-2.csv"}


def test_replayed_epoch_is_skipped(spark, sf_small, scratch):
    from haulwise.sources.upsert import audit_path_for, read_audit
    from haulwise.streaming.ingest import ingest_epoch

    feed = route_days(spark, sf_small).where(F.col("date") < "1995-03-01")
    root = os.path.join(scratch, "root")
    epoch = feed.select(*SOURCE_COLUMNS).withColumn("source_file", F.lit("drop.csv"))
    first = ingest_epoch(spark, root, epoch, "stream-x-0")
    assert first["audit"]["inserted"] == feed.count()
    # the same epoch delivered again (crash before the stream committed it)
    assert ingest_epoch(spark, root, epoch, "stream-x-0") is None
    audit = read_audit(spark, audit_path_for(root, "route_days")).collect()
    assert [r["batch_id"] for r in audit] == ["stream-x-0"]
    assert read_bronze(spark, root).count() == feed.count()
