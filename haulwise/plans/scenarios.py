"""Storage-level read-outs: each runs the real table jobs (CSV round trip,
upsert, load history, clustering, compaction, partitioned sink) on data
derived from the input tables, in a fresh folder under the shared
checkpoint root, and returns what a reader would see."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.functions import sketches
from haulwise.functions.metrics import THRESHOLD_QUANTILE, safe_div
from haulwise.operators import gold as gold_ops, quality
from haulwise.operators.silver import ROUTE_COLUMNS
from haulwise.operators.gold_state import gold_of_state
from haulwise.plans.medallion import (
    BRONZE_PARTITIONS, build_gold_state, ingest_bronze, load_csv, read_bronze, read_gold, read_gold_state, restate,
)
from haulwise.session import cut_lineage, drop_scratch, scratch_path
from haulwise.sources import evolution, layout, snapshots
from haulwise.sources.contract import (
    BRONZE_SCHEMA, KEY, SOURCE_COLUMNS, read_source, schema_check, struct_of, with_ingestion_metadata,
)
from haulwise.sources.tables import layer_path
from haulwise.sources.upsert import audit_path_for, read_audit

# Fixed values of the restatement scenario: re-issued days have their disposal
# cost raised by RESTATE_FACTOR; load times.
RESTATE_FACTOR = 1.1
BASE_TS = "2024-01-01 00:00:00"
RESTATE_TS = "2024-02-01 00:00:00"
RERUN_TS = "2024-03-01 00:00:00"
# About how many keys a bucket of the load history holds.
BUCKET_KEYS = 100_000


def load_dates(feed: DataFrame) -> tuple[dt.date, dt.date]:
    """(base_end, restate_from), at three quarters and at half of the feed's
    days: the base load holds the days before the first, the restatement
    batch those from the second on."""
    lo, hi = feed.agg(F.min("date"), F.max("date")).first()
    if lo is None:
        lo = hi = dt.date(1970, 1, 1)
    span = (hi - lo).days
    return lo + dt.timedelta(span * 3 // 4), lo + dt.timedelta(span // 2)


def base_batch(feed: DataFrame, base_end: dt.date) -> DataFrame:
    return with_ingestion_metadata(feed.where(F.col("date") < F.lit(base_end)), BASE_TS)


def restatement_batch(feed: DataFrame, base_end: dt.date, restate_from: dt.date,
                      ts: str = RESTATE_TS) -> DataFrame:
    """Days from ``restate_from`` on; days already in the base load get a
    restated disposal cost and the dependent totals recomputed."""
    b = feed.where(F.col("date") >= F.lit(restate_from))
    restated = F.col("date") < F.lit(base_end)
    disposal = F.col("disposal_cost") * F.lit(RESTATE_FACTOR)
    cost = F.col("total_cost") - F.col("disposal_cost") + disposal
    profit = F.col("total_revenue") - cost
    b = b.select(
        *[c for c in SOURCE_COLUMNS if c not in (
            "disposal_cost", "total_cost", "net_revenue", "gross_profit", "gross_margin_pct")],
        F.when(restated, disposal).otherwise(F.col("disposal_cost")).alias("disposal_cost"),
        F.when(restated, cost).otherwise(F.col("total_cost")).alias("total_cost"),
        F.when(restated, F.col("total_revenue") - disposal)
        .otherwise(F.col("net_revenue")).alias("net_revenue"),
        F.when(restated, profit).otherwise(F.col("gross_profit")).alias("gross_profit"),
        F.when(restated, safe_div(profit, "total_revenue") * 100)
        .otherwise(F.col("gross_margin_pct")).alias("gross_margin_pct"),
    ).select(*SOURCE_COLUMNS)
    return with_ingestion_metadata(b, ts)


class Restatement:
    """Base load, restatement and an identical re-run into one Bronze table,
    each also appended to the load history. ``feed`` is read by every load: a
    stored table, or with ``late`` narrow rows of one."""

    def __init__(self, spark, feed: DataFrame, late: layout.Late = layout.AS_IS):
        self.spark = spark
        self.narrow, self.late = feed, late
        self.feed = late.widen(feed)
        self.root = scratch_path(spark, "restatement")
        self.base_end, self.restate_from = load_dates(self.feed)

    def base(self) -> DataFrame:
        return base_batch(self.feed, self.base_end)

    def batch(self, ts: str = RESTATE_TS) -> DataFrame:
        return restatement_batch(self.feed, self.base_end, self.restate_from, ts)

    def base_rows(self) -> tuple[DataFrame, layout.Late]:
        """The base load's narrow rows, and how they become the load."""
        return (self.narrow.where(F.col("date") < F.lit(self.base_end)),
                layout.Late(lambda rows: base_batch(self.late.widen(rows), self.base_end), self.late.columns))

    def batch_rows(self, ts: str = RESTATE_TS) -> tuple[DataFrame, layout.Late]:
        return (self.narrow.where(F.col("date") >= F.lit(self.restate_from)),
                layout.Late(lambda rows: restatement_batch(self.late.widen(rows), self.base_end, self.restate_from, ts),
                            self.late.columns))

    def ingest(self, name: str, rows: DataFrame, late: layout.Late) -> None:
        ingest_bronze(self.spark, self.root, rows, name, land=False, late=late)

    def load(self) -> Restatement:
        self.ingest("base", *self.base_rows())
        self.ingest("restatement", *self.batch_rows())
        self.ingest("rerun", *self.batch_rows(RERUN_TS))
        return self

    def keyed(self, *loads: DataFrame) -> snapshots.Keyed:
        """The loads stored together in buckets by key."""
        held = snapshots.Keyed(self.spark, scratch_path(self.spark, "keyed"), KEY, self.buckets)
        for load in loads:
            held.append(load)
        return held

    def dealt(self) -> Restatement:
        """From here on loads come dealt by key, in buckets of the same number:
        the narrow rows are, and each load is made of them where it is used."""
        self.buckets = max(1, math.ceil(self.narrow.count() / BUCKET_KEYS))
        self.feed = self.late.widen(self.narrow.repartition(self.buckets, self.late.column(KEY)))
        return self

    def history_table(self, rerun: bool = False) -> snapshots.Keyed:
        self.dealt()
        return self.keyed(self.base(), self.batch(), *([self.batch(RERUN_TS)] if rerun else []))

    def history(self, rerun: bool = False) -> DataFrame:
        return self.history_table(rerun).rows()


def _with_load_text(df: DataFrame) -> DataFrame:
    """Replace ``ingestion_ts`` by its wall-clock text: the same in every
    session time zone, so read-outs compare stably across engines."""
    return (df.withColumn("load_ts", F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm:ss"))
            .drop("ingestion_ts", "source_file"))


def upsert_result(spark, feed: DataFrame, late: layout.Late = layout.AS_IS) -> DataFrame:
    """A4-A5: the Bronze table after base load, restatement and re-run."""
    return _with_load_text(read_bronze(spark, Restatement(spark, feed, late).load().root))


def load_audit(spark, feed: DataFrame, late: layout.Late = layout.AS_IS) -> DataFrame:
    """The load history of the three loads."""
    return read_audit(spark, audit_path_for(Restatement(spark, feed, late).load().root, "route_days"))


def snapshot_as_of(spark, feed: DataFrame, late: layout.Late = layout.AS_IS) -> DataFrame:
    """A10: the table as of the base load, from the history of both loads."""
    return _with_load_text(snapshots.as_of(Restatement(spark, feed, late).history(), BASE_TS, [KEY]))


def snapshot_diff(spark, feed: DataFrame, late: layout.Late = layout.AS_IS) -> DataFrame:
    """A10: what the restatement changed between the two load times."""
    history = Restatement(spark, feed, late).history()
    return snapshots.diff(snapshots.as_of(history, BASE_TS, [KEY]), snapshots.as_of(history, RESTATE_TS, [KEY]), [KEY])


def _interval_text(df: DataFrame) -> DataFrame:
    """The interval's ends as wall-clock text, as in :func:`_with_load_text`."""
    return df.select(*SOURCE_COLUMNS, *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("valid_from", "valid_to")])


def history_intervals(spark, feed: DataFrame, late: layout.Late = layout.AS_IS) -> DataFrame:
    """A10: the states of all keys over three loads, the last of which repeats
    the second. The base load's states are stored and each later load is
    worked into them; both lie in buckets by key. What new states were made of
    goes as soon as they are stored."""
    scenario = Restatement(spark, feed, late).dealt()
    made_of = [scenario.keyed(scenario.base())]
    states = snapshots.intervals(made_of[0].rows(), [KEY])
    for ts in (RESTATE_TS, RERUN_TS):
        held = scenario.keyed(states)
        for table in made_of:
            table.drop()
        load = scenario.keyed(scenario.batch(ts))
        states = snapshots.extend_intervals(held.rows(), load.rows(), KEY)
        made_of = [held, load]
    return _interval_text(states)


def snapshot_as_of_range(spark, feed: DataFrame, late: layout.Late = layout.AS_IS) -> DataFrame:
    """A10: the table as of the restatement, a filter on the intervals that
    the history of all three loads makes."""
    history = Restatement(spark, feed, late).history_table(rerun=True)
    states = cut_lineage(snapshots.intervals(history.rows(), [KEY]), "history-intervals")
    history.drop()
    return _interval_text(snapshots.as_of_intervals(states, RESTATE_TS))


def _evolving_loads(spark, feed: DataFrame) -> str:
    """Two loads of different schema: the second has a column more, one less,
    and two of wider types."""
    root = scratch_path(spark, "evolving")
    base_end, _ = load_dates(feed)
    first, second = feed.where(F.col("date") < F.lit(base_end)), feed.where(F.col("date") >= F.lit(base_end))
    evolution.write_load(first, root, "first", BASE_TS)
    evolution.write_load(second.drop("day_of_week").withColumns({
        "delay_minutes": F.col("delay_minutes").cast("bigint"), "total_stops": F.col("total_stops").cast("double"),
        "recycled_tonnes": F.col("total_tonnes") * 0.25}), root, "second", RESTATE_TS)
    return root


def evolved_rows(spark, feed: DataFrame) -> DataFrame:
    """One read over loads of different schema."""
    return evolution.read_merged(spark, _evolving_loads(spark, feed))


def schema_changes(spark, feed: DataFrame) -> DataFrame:
    """What changed in the schema from load to load."""
    return evolution.schema_changes(spark, _evolving_loads(spark, feed))


def threshold_from_sketches(spark, feed: DataFrame, late: layout.Late = layout.AS_IS) -> DataFrame:
    """C25 from stored quantile sketches: made for every month of the base
    load, and anew for the months that the restatement touches; the threshold
    of the table after it, and how many values it has."""
    scenario = Restatement(spark, feed, late)
    scenario.ingest("base", *scenario.base_rows())
    m, by = "gross_margin_pct", list(BRONZE_PARTITIONS)
    held = cut_lineage(sketches.quantile_sketches(read_bronze(spark, scenario.root), m, by), "quantile-sketches")
    scenario.ingest("restatement", *scenario.batch_rows())
    bronze = read_bronze(spark, scenario.root)
    months = scenario.batch().select(*by).distinct()
    new = sketches.quantile_sketches(bronze.join(months, by, "left_semi"), m, by)
    held = cut_lineage(sketches.replace_partitions(held, new, by), "quantile-sketches")
    thr = sketches.threshold_from_sketches(bronze, m, THRESHOLD_QUANTILE, held)
    return held.agg(F.sum("n").alias("n_values")).select(F.lit(thr).alias("threshold"), "n_values")


def distinct_from_sketches(feed: DataFrame) -> DataFrame:
    """B2, B9, B10 from sketches by month: distinct keys and distinct
    route-months, counted exactly and estimated, and whether the estimate's
    bounds hold the exact count."""
    by, parts = list(BRONZE_PARTITIONS), []
    for name, key in (("route_date_key", F.col(KEY)), ("route_month", F.concat_ws("|", "route_id", "year", "month"))):
        rows = feed.select(*by, key.alias("v"))
        told = sketches.distinct_estimate(sketches.distinct_sketches(rows, "v", by))
        exact = rows.select("v").distinct().agg(F.count(F.lit(1)).alias("distinct_exact"))
        # one row each: bounded
        parts.append(told.join(F.broadcast(exact), F.lit(True)).select(
            F.lit(name).alias("key"), "partitions", "row_count", "distinct_exact",
            F.col("distinct_exact").between(F.col("low"), F.col("high")).alias("within_bounds")))
    return parts[0].unionByName(parts[1])


def route_file_skipping(spark, silver: DataFrame, files_per_partition: int = 8,
                        late: layout.Late = layout.AS_IS) -> DataFrame:
    """For every route, the Silver files whose statistics do not rule
    out its drill-down (bu, area, route), before and after clustering. Either
    layout has about ``files_per_partition`` files a partition. ``silver`` is
    read several times: a stored table, or narrow rows of one."""
    cols, root = ["bu", "area", "route_id"], scratch_path(spark, "file-skipping")
    parts = ["year", "region"]
    rows, values = silver.count(), silver.select(*[late.column(c).alias(c) for c in parts]).distinct().count()
    rows_per_file = max(1, rows // max(1, values * files_per_partition))
    routes = cut_lineage(silver.select(*[late.column(c).alias(c) for c in cols]).distinct(), "routes")
    out, files = routes, None
    for state in ("plain", "clustered"):
        if state == "plain":
            layout.write_partitioned(silver, f"{root}/plain", parts, max_records_per_file=rows_per_file, late=late)
            files = layout.file_count(spark, f"{root}/plain")
        else:
            layout.write_partitioned(silver, f"{root}/clustered", parts, cols, num_files=files, late=late)
        stats = cut_lineage(layout.file_stats(spark, f"{root}/{state}", cols), "file-stats")
        drop_scratch(spark, f"{root}/{state}")  # from here on its statistics are read
        touched = layout.files_touched(routes, stats, cols, "route_id").withColumnRenamed("files", f"files_{state}")
        out = out.join(touched, cols, "left")
    return out.select(*cols, *[F.coalesce(f"files_{s}", F.lit(0)).alias(f"files_{s}") for s in ("plain", "clustered")])


def gold_incremental(spark, feed: DataFrame, late: layout.Late = layout.AS_IS) -> DataFrame:
    """The fact after a restatement that only changed days went into."""
    scenario = Restatement(spark, feed, late)
    scenario.ingest("base", *scenario.base_rows())
    thr = build_gold_state(spark, scenario.root)
    layout.write_partitioned(gold_of_state(read_gold_state(spark, scenario.root)[0], thr),
                             layer_path(scenario.root, "gold", "route_months"), gold_ops.GOLD_PARTITIONS)
    rows, widen = scenario.batch_rows()
    restate(spark, scenario.root, rows, "restatement", widen)
    return read_gold(spark, scenario.root)


def write_csv(feed: DataFrame, path: str) -> None:
    """The feed as CSV files under the source contract, compressed: the text of
    39 columns is several times as long as all else that is written of a row. A
    file, which is read as a whole, has the rows of one task."""
    feed.write.option("header", True).option("dateFormat", "yyyy-MM-dd").option("compression", "gzip").csv(path)


def csv_load_readback(spark, feed: DataFrame) -> DataFrame:
    """The feed as CSV files, batch-loaded into Bronze; rows, keys
    and partitions of the written table."""
    root = scratch_path(spark, "csv-load")
    path = f"{root}/landing"
    write_csv(feed, path)
    load_csv(spark, root, path, "csv", BASE_TS, landed=lambda: drop_scratch(spark, path))
    bronze = read_bronze(spark, root)
    parts = quality.partition_inventory(bronze).agg(F.count(F.lit(1)).alias("partitions"))
    # one row each: bounded
    return quality.duplicate_key_summary(bronze).join(F.broadcast(parts), F.lit(True))


def contract_roundtrip(spark, feed: DataFrame) -> DataFrame:
    """A1-A2: the feed written as CSV with a header, read back through the
    enforced contract scan, with ingestion metadata attached."""
    path = scratch_path(spark, "csv")
    write_csv(feed, path)
    back = with_ingestion_metadata(read_source(spark, path), BASE_TS)
    return back.select(
        *SOURCE_COLUMNS,
        (F.col("source_file").rlike(r"\.csv(\.gz)?$")).alias("has_source_file"),
        F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm:ss").alias("load_ts"),
    )


def contract_schema_check(spark, gold: DataFrame) -> DataFrame:
    """Live schema of the written Gold fact and dims vs the expected
    contract, one row per expected or unexpected column."""
    root = scratch_path(spark, "star")
    layout.write_partitioned(gold, f"{root}/fact", gold_ops.GOLD_PARTITIONS)
    fact = spark.read.schema(struct_of(gold_ops.GOLD_FIELDS)).parquet(f"{root}/fact")
    gold_ops.dim_route(fact, ordered=False).write.parquet(f"{root}/dim_route")
    gold_ops.dim_date(fact, ordered=False).write.parquet(f"{root}/dim_date")
    checks = []
    for name, fields in (("fact_route_month_profitability", gold_ops.GOLD_FIELDS),
                         ("dim_route", gold_ops.DIM_ROUTE_FIELDS),
                         ("dim_date", gold_ops.DIM_DATE_FIELDS)):
        path = {"fact_route_month_profitability": "fact"}.get(name, name)
        live = spark.read.parquet(f"{root}/{path}")
        # partition columns come back last; compare by name, report in
        # contract order
        checks.append(schema_check(live, struct_of(fields))
                      .withColumn("table", F.lit(name)))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.select("table", "position", "column", "expected_type", "actual_type", "status", "non_null")


def zorder_rows(silver: DataFrame) -> DataFrame:
    """Each Silver row's z-order value over (bu, area, route_id)."""
    z = layout.zorder_value(silver, ["bu", "area", "route_id"], "zorder_key")
    return z.select("route_date_key", "year", "region", "bu", "area", "route_id", "zorder_key")


def clustered_rows(spark, silver: DataFrame, late: layout.Late = layout.AS_IS) -> DataFrame:
    """Silver rewritten partitioned by (year, region) and z-ordered
    by (bu, area, route_id); the rows a reader gets back."""
    path = scratch_path(spark, "silver-clustered")
    layout.write_partitioned(silver, path, ["year", "region"], ["bu", "area", "route_id"], late=late)
    return spark.read.parquet(path).select(
        "route_date_key", "year", "region", "bu", "area", "route_id",
        "gross_margin_pct", "underperforming_flag", *ROUTE_COLUMNS)


def compacted_rows(spark, silver: DataFrame, target_rows_per_file: int = 20_000,
                   late: layout.Late = layout.AS_IS) -> DataFrame:
    """Silver compacted to about ``target_rows_per_file`` rows per file."""
    path = scratch_path(spark, "silver-compacted")
    layout.compact(silver, path, ["year", "region"], target_rows_per_file, late)
    return spark.read.parquet(path).select(
        "route_date_key", "year", "region", "gross_margin_pct", "underperforming_flag")


def pruned_slice(spark, gold: DataFrame, region: str = "EUROPE") -> DataFrame:
    """The Gold fact written partitioned by (region, bu, area), read
    back through a region filter — the scan lists only that region's
    directories (``PartitionFilters``)."""
    path = scratch_path(spark, "gold")
    layout.write_partitioned(gold, path, gold_ops.GOLD_PARTITIONS)
    return spark.read.parquet(path).where(F.col("region") == region)
