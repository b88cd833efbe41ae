"""Silver: route-day grain with unit economics, the data-driven day flag,
its reason text and the coarser per-route rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from haulwise.functions.metrics import (
    below_threshold, exact_sum, safe_div, threshold_text, weighted_pct,
)
from haulwise.functions.quantile import (
    compute_underperformance_threshold, discrete_quantiles,
)
from haulwise.operators.dedupe import dedupe_latest
from haulwise.sources.contract import (
    BRONZE_COLUMNS, BRONZE_SCHEMA, KEY, NO_INCIDENT_SENTINEL, struct_of,
)

# Derived unit-economics measures (name, numerator, denominator).
PER_STOP = [
    ("revenue_per_completed_stop", "total_revenue", "completed_stops"),
    ("cost_per_completed_stop", "total_cost", "completed_stops"),
    ("profit_per_completed_stop", "gross_profit", "completed_stops"),
]
DENSITY = [
    ("revenue_per_km", "total_revenue", "total_distance_km"),
    ("cost_per_km", "total_cost", "total_distance_km"),
    ("profit_per_km", "gross_profit", "total_distance_km"),
    ("fuel_litres_per_100km", "total_fuel_used_litres * 100", "total_distance_km"),
    ("stops_per_labour_hour", "completed_stops", "total_labour_hours"),
]
PER_TONNE = [
    ("revenue_per_tonne", "total_revenue", "total_tonnes"),
    ("cost_per_tonne", "total_cost", "total_tonnes"),
    ("profit_per_tonne", "gross_profit", "total_tonnes"),
    ("disposal_cost_per_tonne", "disposal_cost", "total_tonnes"),
]
HEALTH = [
    ("completion_rate", "completed_stops", "total_stops"),
    ("missed_stop_rate", "missed_stops", "total_stops"),
]
COST_SHARES = [
    ("disposal_cost_share", "disposal_cost", "total_cost"),
    ("fuel_cost_share", "fuel_cost", "total_cost"),
    ("labour_cost_share", "labour_cost", "total_cost"),
    ("maintenance_cost_share", "maintenance_cost", "total_cost"),
    ("admin_cost_share", "admin_cost", "total_cost"),
]
UNIT_METRICS = PER_STOP + DENSITY + PER_TONNE + HEALTH + COST_SHARES

# Route rule — a route is persistently weak when its weighted
# margin is under the threshold or at least this share of its days is flagged.
PERSISTENT_DAY_SHARE = 0.20

# Reason-text fragments and their trigger levels, in order.
REASON_LEAD = "margin "
NEGATIVE_PROFIT = "; negative gross profit"
DISPOSAL_HEAVY = "; disposal-heavy (>40% of cost)"
LOW_COMPLETION = "; low completion (<90%)"
FUEL_HEAVY = "; fuel-heavy (>30% of cost)"
DISPOSAL_HEAVY_SHARE = 0.40
LOW_COMPLETION_RATE = 0.90
FUEL_HEAVY_SHARE = 0.30

METRIC_COLUMNS = [name for name, _, _ in UNIT_METRICS]
ROUTE_COLUMNS = [
    "route_weighted_margin_pct", "route_pct_days_under",
    "route_persistent_underperformer",
]
# The Silver contract behind Bronze's columns (name, type).
SILVER_FIELDS = (
    [(n, "double") for n in METRIC_COLUMNS]
    + [("underperforming_flag", "boolean"), ("underperformance_reason", "string"),
       ("route_weighted_margin_pct", "double"), ("route_pct_days_under", "double"),
       ("route_persistent_underperformer", "boolean")]
)
SILVER_SCHEMA = StructType(BRONZE_SCHEMA.fields + struct_of(SILVER_FIELDS).fields)


def keep_latest(bronze: DataFrame) -> DataFrame:
    """One row per ``route_date_key``, latest ``ingestion_ts`` first,
    ties broken by the remaining columns so the pick is deterministic."""
    return dedupe_latest(bronze, [KEY], ["ingestion_ts"])


def normalise_sentinel(df: DataFrame) -> DataFrame:
    """The literal no-incident sentinel becomes a real null."""
    return df.withColumn(
        "incident_type", F.nullif(F.col("incident_type"), F.lit(NO_INCIDENT_SENTINEL)))


def add_unit_metrics(df: DataFrame) -> DataFrame:
    """19 null-safe ratios in one projection."""
    return df.select("*", *[safe_div(F.expr(n), d).alias(name) for name, n, d in UNIT_METRICS])


def silver_base(bronze: DataFrame) -> DataFrame:
    """Dedupe (when the frame carries load timestamps), normalise the
    sentinel and add the unit metrics. A feed without ``ingestion_ts`` is
    taken as already unique on the key (the adapter output is)."""
    df = keep_latest(bronze) if "ingestion_ts" in bronze.columns else bronze
    return add_unit_metrics(normalise_sentinel(df))


def underperformance_reason(threshold: float):
    """``margin <m>% < <thr>%`` followed by each contributing condition
    in fixed order; null on days that are not flagged."""
    lead = F.concat(F.lit(REASON_LEAD),
                    F.round("gross_margin_pct", 1).cast("string"),
                    F.lit(f"% < {threshold_text(threshold)}%"))
    text = F.concat_ws(
        "", lead,
        F.when(F.col("gross_profit") < 0, F.lit(NEGATIVE_PROFIT)),
        F.when(F.col("disposal_cost_share") > DISPOSAL_HEAVY_SHARE, F.lit(DISPOSAL_HEAVY)),
        F.when(F.col("completion_rate") < LOW_COMPLETION_RATE, F.lit(LOW_COMPLETION)),
        F.when(F.col("fuel_cost_share") > FUEL_HEAVY_SHARE, F.lit(FUEL_HEAVY)),
    )
    return F.when(F.col("underperforming_flag"), text).otherwise(F.lit(None).cast("string"))


def route_rollup(flagged: DataFrame, threshold: float) -> DataFrame:
    """C28-C30 at route grain: one row per route with the weighted margin,
    the flagged-day share and the persistent rule.

    An aggregate (partial on the map side) instead of an unframed window:
    a long route never has to fit in one task."""
    return (
        flagged.groupBy("route_id")
        .agg(
            weighted_pct("gross_profit", "total_revenue").alias("route_weighted_margin_pct"),
            safe_div(F.sum(F.col("underperforming_flag").cast("int")),
                     F.count(F.lit(1))).alias("route_pct_days_under"),
        )
        .withColumn(
            "route_persistent_underperformer",
            below_threshold("route_weighted_margin_pct", threshold)
            | (F.col("route_pct_days_under") >= PERSISTENT_DAY_SHARE),
        )
    )


def flag_days(base: DataFrame, threshold: float) -> DataFrame:
    """C26 + C27 on top of ``silver_base``."""
    return (
        base.withColumn("underperforming_flag", below_threshold("gross_margin_pct", threshold))
        .withColumn("underperformance_reason", underperformance_reason(threshold))
    )


def finish_silver(base: DataFrame, threshold: float, narrow: DataFrame | None = None) -> DataFrame:
    """Flags, reason text and the per-route columns on top of
    ``silver_base``, in Silver column order. ``narrow``: the rows' route_id,
    margin, profit and revenue, if they were stored on the way; the route
    rollup then reads them and not the whole base again."""
    flagged = flag_days(base, threshold)
    days = flagged if narrow is None else narrow.withColumn(
        "underperforming_flag", below_threshold("gross_margin_pct", threshold))
    routes = route_rollup(days, threshold)
    return in_order(flagged.join(routes, "route_id", "left"))


def in_order(silver: DataFrame) -> DataFrame:
    """Silver's column order: Bronze's, the derived ones, the route's."""
    lead = [c for c in BRONZE_COLUMNS if c in silver.columns]
    tail = [c for c in silver.columns if c not in lead and c not in ROUTE_COLUMNS]
    return silver.select(*lead, *tail, *ROUTE_COLUMNS)


def build_silver(bronze: DataFrame, threshold: float | None = None) -> tuple[DataFrame, float]:
    """The full Silver frame (65 columns for a Bronze input) and the
    threshold it used. The threshold is computed from the data (exact P10,
    rounded) unless given.

    The per-route columns are joined back on ``route_id``; the route table
    has one row per route, so the planner broadcasts it when its measured
    size is small (AQE) and otherwise shuffles both sides on the key, with
    skewed partitions split by AQE's skew-join handling.
    """
    base = silver_base(bronze)
    if threshold is None:
        threshold = compute_underperformance_threshold(base, "gross_margin_pct")
    return finish_silver(base, threshold), threshold


# ----------------------------------------------------------------------
# Silver read-outs
# ----------------------------------------------------------------------

def margin_profile(silver: DataFrame, exact: bool = True, stored: bool = False) -> DataFrame:
    """P10/25/50/75/90, mean/min/max of the margin (2 dp) and the
    negative-profit day count and share.

    ``exact`` takes each percentile with the distributed exact selection
    (deterministic, comparable across engines); otherwise
    ``percentile_approx`` with 1/1000 relative error as in the reference's
    profile. Either way no task holds more than a bounded summary. ``stored``:
    the frame is a scan of a table, whose column need not be copied first."""
    m = F.col("gross_margin_pct")
    names = ["p10", "p25", "p50", "p75", "p90"]
    pcts = [0.10, 0.25, 0.50, 0.75, 0.90]
    if exact:
        vals = discrete_quantiles(silver, "gross_margin_pct", pcts, materialize=not stored)
        qs = [F.lit(v).cast("double") for v in vals]
    else:
        qs = [F.percentile_approx(m, p, 1000) for p in pcts]
    n = F.count(F.lit(1))
    neg = F.count_if(F.col("gross_profit") < 0)
    return silver.agg(
        *[F.round(q, 2).alias(nm) for q, nm in zip(qs, names)],
        F.round(F.avg(m), 2).alias("mean"),
        F.round(F.min(m), 2).alias("min"),
        F.round(F.max(m), 2).alias("max"),
        n.alias("n_rows"),
        neg.alias("n_negative_profit"),
        F.round(safe_div(neg * 100, n), 2).alias("pct_negative_profit"),
    )


def persistent_routes(silver: DataFrame) -> DataFrame:
    """Distinct persistent routes with geography, worst first."""
    return (
        silver.where(F.col("route_persistent_underperformer"))
        .select("route_id", "region", "bu", "area",
                "route_weighted_margin_pct", "route_pct_days_under")
        .distinct()
        .orderBy("route_weighted_margin_pct", "route_id")
    )


def rule_counts(silver: DataFrame) -> DataFrame:
    """Day and route counts under the chosen rule.

    Two aggregates, both partial on the map side: one row per route (its
    days, flagged days and persistent flag), then totals. Distinct routes are
    counted as route rows, so there is no ``count(DISTINCT)`` expand that
    duplicates every day before the shuffle. A null route id counts towards
    days but not routes, as ``count(DISTINCT route_id)`` would."""
    per_route = silver.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("d"),
        F.count_if(F.col("underperforming_flag")).alias("u"),
        F.max(F.col("route_persistent_underperformer")).alias("p"),
    )
    days = F.sum("d").cast("bigint")
    under = F.sum("u").cast("bigint")
    routes = F.count_if(F.col("route_id").isNotNull())
    persistent = F.count_if(F.col("route_id").isNotNull() & F.col("p"))
    return per_route.agg(
        days.alias("route_days"),
        under.alias("underperforming_days"),
        F.round(safe_div(under * 100, days), 2).alias("pct_underperforming_days"),
        routes.alias("routes"),
        persistent.alias("persistent_routes"),
        F.round(safe_div(persistent * 100, routes), 2).alias("pct_persistent_routes"),
    )


def flagged_examples(silver: DataFrame) -> DataFrame:
    """Flagged days with their margin and reason."""
    return silver.where(F.col("underperforming_flag")).select(
        "route_date_key", "gross_margin_pct", "underperformance_reason")


def fleet_totals(silver: DataFrame) -> DataFrame:
    """Fleet revenue, cost, profit and weighted margin."""
    return silver.agg(
        exact_sum("total_revenue").alias("total_revenue"),
        exact_sum("total_cost").alias("total_cost"),
        exact_sum("gross_profit").alias("gross_profit"),
        F.round(weighted_pct("gross_profit", "total_revenue"), 2).alias("weighted_margin"),
    )
