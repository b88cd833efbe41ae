"""Gold: route-month fact and the flat star schema around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.functions.metrics import below_threshold, exact_sum, safe_div

GRAIN = ["route_id", "year", "month", "quarter", "region", "bu", "area"]

# Additive measures summed to the month (double measures).
SUMMED_DOUBLES = [
    "total_revenue", "total_cost", "net_revenue", "gross_profit",
    "disposal_cost", "fuel_cost", "labour_cost", "maintenance_cost", "admin_cost",
    "total_tonnes", "total_yards", "total_distance_km",
    "total_fuel_used_litres", "total_labour_hours",
]
SUMMED_COUNTS = ["completed_stops", "total_stops", "missed_stops"]

# Ratios recomputed from the month sums (name, num, den).
MONTH_RATIOS = [
    ("revenue_per_completed_stop", "total_revenue", "completed_stops"),
    ("cost_per_completed_stop", "total_cost", "completed_stops"),
    ("profit_per_completed_stop", "gross_profit", "completed_stops"),
    ("revenue_per_tonne", "total_revenue", "total_tonnes"),
    ("cost_per_tonne", "total_cost", "total_tonnes"),
    ("profit_per_tonne", "gross_profit", "total_tonnes"),
    ("disposal_cost_per_tonne", "disposal_cost", "total_tonnes"),
    ("fuel_litres_per_100km", "total_fuel_used_litres * 100", "total_distance_km"),
    ("stops_per_labour_hour", "completed_stops", "total_labour_hours"),
    ("completion_rate", "completed_stops", "total_stops"),
    ("missed_stop_rate", "missed_stops", "total_stops"),
    ("disposal_cost_share", "disposal_cost", "total_cost"),
    ("fuel_cost_share", "fuel_cost", "total_cost"),
    ("labour_cost_share", "labour_cost", "total_cost"),
    ("maintenance_cost_share", "maintenance_cost", "total_cost"),
    ("admin_cost_share", "admin_cost", "total_cost"),
    ("pct_underperforming_days", "underperforming_days", "n_route_days"),
]
GOLD_PARTITIONS = ["region", "bu", "area"]


def gold_sums(silver: DataFrame) -> DataFrame:
    """The route-month rollup (partial + final hash aggregate)."""
    return silver.groupBy(*GRAIN).agg(
        F.count(F.lit(1)).alias("n_route_days"),
        *[exact_sum(c).alias(c) for c in SUMMED_DOUBLES],
        *[F.sum(c).cast("bigint").alias(c) for c in SUMMED_COUNTS],
        F.sum("incident_flag").cast("bigint").alias("incident_days"),
        F.sum(F.col("underperforming_flag").cast("int")).cast("bigint")
        .alias("underperforming_days"),
    )


def build_gold(silver: DataFrame, threshold: float) -> DataFrame:
    """The 46-column route-month fact. The month flag compares the
    revenue-weighted monthly margin with the *day-level* threshold."""
    return gold_from_sums(gold_sums(silver), threshold)


def gold_from_sums(sums: DataFrame, threshold: float) -> DataFrame:
    """D2-D3 on top of the month sums."""
    ratios = [(safe_div("gross_profit", "total_revenue") * 100)
              .alias("weighted_gross_margin_pct")]
    ratios += [safe_div(F.expr(n), d).alias(name) for name, n, d in MONTH_RATIOS]
    out = sums.select("*", *ratios)
    return out.withColumn(
        "month_underperforming_flag",
        below_threshold("weighted_gross_margin_pct", threshold))


def dim_route(rows: DataFrame, ordered: bool = True) -> DataFrame:
    """Natural key plus denormalised geography, from Silver or Gold."""
    out = rows.select("route_id", "region", "bu", "area").distinct()
    return out.orderBy("route_id", "region", "bu", "area") if ordered else out


def dim_date(rows: DataFrame, ordered: bool = True) -> DataFrame:
    """Calendar at month grain, ``date_month_key = year*100 + month``, from
    Silver or Gold."""
    out = rows.select("year", "month", "quarter").distinct().select(
        (F.col("year") * 100 + F.col("month")).alias("date_month_key"),
        "year", "month", "quarter",
        F.make_date("year", "month", F.lit(1)).alias("month_start_date"),
    )
    return out.orderBy("date_month_key", "quarter") if ordered else out


def grain_check(gold: DataFrame) -> DataFrame:
    """Fact rows vs distinct (route, year, month) — equal when the
    grain holds."""
    return gold.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_distinct("route_id", "year", "month").alias("distinct_grain_keys"),
    )


def geo_dependency_violations(silver: DataFrame) -> DataFrame:
    """Routes mapped to more than one region, bu or area (must be
    empty for the flat star).

    ``min <> max`` per route answers "more than one distinct value" with a
    partial aggregate (no distinct-expansion); a route mixing null and
    non-null geography is caught by the null count."""
    agg = silver.groupBy("route_id").agg(
        *[F.min(c).alias(f"min_{c}") for c in ("region", "bu", "area")],
        *[F.max(c).alias(f"max_{c}") for c in ("region", "bu", "area")],
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("region", "bu", "area")],
        F.count(F.lit(1)).alias("days"),
    )
    bad = None
    for c in ("region", "bu", "area"):
        cond = (F.col(f"min_{c}") != F.col(f"max_{c}")) | (
            (F.col(f"null_{c}") > 0) & (F.col(f"null_{c}") < F.col("days")))
        bad = cond if bad is None else (bad | cond)
    return agg.where(bad).select(
        "route_id",
        *[F.col(f"min_{c}").alias(f"{c}_min") for c in ("region", "bu", "area")],
        *[F.col(f"max_{c}").alias(f"{c}_max") for c in ("region", "bu", "area")],
    )


def star_slice(gold: DataFrame, routes: DataFrame, dates: DataFrame,
               by: list[str]) -> DataFrame:
    """The documented star join — fact ⋈ dim_route on ``route_id`` and
    fact ⋈ dim_date on ``(year, month)`` — then a revenue-weighted slice by
    any dimension attributes.

    Both dimension joins are left to the planner's size check: ``dim_date``
    (12 rows per year) is always broadcast by it, ``dim_route`` grows with
    the fleet and is broadcast only while it measures small. The fact's own
    geography columns are dropped so the slice really reads them from the
    dimension."""
    fact = gold.select("route_id", "year", "month", "n_route_days",
                       "total_revenue", "gross_profit")
    d = dates.select("year", "month", "date_month_key", "quarter", "month_start_date")
    joined = (
        fact.join(routes, "route_id")
        .join(d, ["year", "month"])
    )
    return (
        joined.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("route_months"),
            F.sum("n_route_days").cast("bigint").alias("route_days"),
            exact_sum("total_revenue").alias("total_revenue"),
            exact_sum("gross_profit").alias("gross_profit"),
            F.round(safe_div(exact_sum("gross_profit"), exact_sum("total_revenue")) * 100, 2)
            .alias("weighted_margin"),
        )
        .orderBy(*by)
    )


# The live schema of the star tables (name, type), in order.
GOLD_FIELDS = [
    ("route_id", "string"), ("year", "int"), ("month", "int"), ("quarter", "string"),
    ("region", "string"), ("bu", "string"), ("area", "string"),
    ("n_route_days", "bigint"),
    ("total_revenue", "double"), ("total_cost", "double"), ("net_revenue", "double"),
    ("gross_profit", "double"), ("disposal_cost", "double"), ("fuel_cost", "double"),
    ("labour_cost", "double"), ("maintenance_cost", "double"), ("admin_cost", "double"),
    ("total_tonnes", "double"), ("total_yards", "double"), ("total_distance_km", "double"),
    ("total_fuel_used_litres", "double"), ("total_labour_hours", "double"),
    ("completed_stops", "bigint"), ("total_stops", "bigint"), ("missed_stops", "bigint"),
    ("incident_days", "bigint"), ("underperforming_days", "bigint"),
    ("weighted_gross_margin_pct", "double"), ("revenue_per_completed_stop", "double"),
    ("cost_per_completed_stop", "double"), ("profit_per_completed_stop", "double"),
    ("revenue_per_tonne", "double"), ("cost_per_tonne", "double"),
    ("profit_per_tonne", "double"), ("disposal_cost_per_tonne", "double"),
    ("fuel_litres_per_100km", "double"), ("stops_per_labour_hour", "double"),
    ("completion_rate", "double"), ("missed_stop_rate", "double"),
    ("disposal_cost_share", "double"), ("fuel_cost_share", "double"),
    ("labour_cost_share", "double"), ("maintenance_cost_share", "double"),
    ("admin_cost_share", "double"), ("pct_underperforming_days", "double"),
    ("month_underperforming_flag", "boolean"),
]
DIM_ROUTE_FIELDS = [("route_id", "string"), ("region", "string"), ("bu", "string"),
                    ("area", "string")]
DIM_DATE_FIELDS = [("date_month_key", "int"), ("year", "int"), ("month", "int"),
                   ("quarter", "string"), ("month_start_date", "date")]
