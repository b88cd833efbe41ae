"""ANSI-SQL twins of the catalog queries, for DuckDB.

Each twin recomputes its query from the raw input tables with plain SQL
(CTEs for the route-day feed, Silver and Gold) so that a Spark result can
be checked against an independent engine. Where Spark's plan differs for
scale (exact quantile selection, aggregate instead of window, max_by
dedupe) the SQL states the textbook form (row_number, window) — same
answer, different algorithm. Names, ratios, dates and types are written out
here and taken from no other module, so a slip there shows as a difference.
"""

from __future__ import annotations

import re


def sdiv(n: str, d: str) -> str:
    return (f"(CASE WHEN CAST({d} AS DOUBLE) = 0 THEN NULL "
            f"ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END)")


def xsum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(20,6))) AS DOUBLE)"


def lossless(sql: str) -> str:
    """The same SQL with every such sum keeping digits past the sixth place."""
    part = r"CAST\(sum\(CAST\((\w+) AS DECIMAL\(20,6\)\)\) AS DOUBLE\)"
    return re.sub(part, r"(\g<0> + sum(\1 - CAST(CAST(\1 AS DECIMAL(20,6)) AS DOUBLE)))", sql)


def wpct(n: str, d: str) -> str:
    return f"({sdiv(xsum(n), xsum(d))} * 100)"


ROUTE_DAYS = """
rd_lines AS (
  SELECT l.l_suppkey AS k, CAST(l.l_shipdate AS DATE) AS d,
         CAST(l.l_quantity AS DECIMAL(6,2)) AS q,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS ext,
         CAST(l.l_discount AS DECIMAL(4,2)) AS disc,
         CAST(p.p_retailprice AS DECIMAL(8,2)) AS rp,
         p.p_size AS sz, p.p_type, c.c_mktsegment, l.l_returnflag, l.l_linestatus
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
),
rd_agg AS (
  SELECT k, d, count(*) AS n_lines,
         count(*) FILTER (WHERE l_returnflag <> 'R') AS n_completed,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_missed,
         sum(sz) AS sum_size, sum(q) AS sum_qty,
         sum(ext * (1 - disc)) AS sum_rev, sum(q * rp) AS sum_qty_retail,
         max(CASE WHEN l_returnflag = 'R' AND disc = 0.10 THEN 1 ELSE 0 END) AS incident,
         min(p_type) AS pws, min(c_mktsegment) AS pcs, min(l_linestatus) AS min_status
  FROM rd_lines GROUP BY k, d
),
rd_geo AS (
  SELECT a.*, r.r_name, n.n_name,
         'RTE-' || printf('%04d', a.k) AS rid,
         CAST(0.20 + 0.05 * (a.k % 4)
              + CASE WHEN a.k % 50 = 3 THEN 2.00 WHEN a.k % 7 = 3 THEN 0.50 ELSE 0.00 END
              AS DECIMAL(4,2)) AS rate
  FROM rd_agg a
  JOIN supplier s ON a.k = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
rd_money AS (
  SELECT *, sum_qty_retail * rate AS disposal_d, sum_size * 60 AS fuel_d,
         n_lines * 400 + sum_size * 10 AS labour_d, sum_size * 5 AS maint_d,
         n_lines * 150 AS admin_d, 0.50 * n_lines + 0.02 * sum_size AS lh_d
  FROM rd_geo
),
rd_cost AS (
  SELECT *, disposal_d + fuel_d + labour_d + maint_d + admin_d AS cost_d FROM rd_money
),
route_days AS (
  SELECT rid || '_' || strftime(d, '%Y-%m-%d') AS route_date_key,
         d AS date,
         CAST(year(d) AS INTEGER) AS year,
         CAST(month(d) AS INTEGER) AS month,
         'Q' || CAST(quarter(d) AS VARCHAR) AS quarter,
         dayname(d) AS day_of_week,
         r_name AS region, n_name AS bu,
         n_name || '-' || CAST(k % 2 AS VARCHAR) AS area,
         rid AS route_id,
         pws AS primary_waste_stream, pcs AS primary_customer_segment,
         CAST(1 + k % 2 AS INTEGER) AS num_drivers,
         CAST(1 AS INTEGER) AS num_trucks,
         CAST(n_lines AS INTEGER) AS total_stops,
         CAST(n_completed AS INTEGER) AS completed_stops,
         CAST(n_missed AS INTEGER) AS missed_stops,
         CAST(sum_size AS DOUBLE) AS total_distance_km,
         CAST(sum_size * 0.40 AS DOUBLE) AS total_fuel_used_litres,
         CAST(lh_d AS DOUBLE) AS total_labour_hours,
         CAST(sum_qty * 1.5 AS DOUBLE) AS total_yards,
         CAST(sum_qty AS DOUBLE) AS total_tonnes,
         CAST(sum_rev AS DOUBLE) / CAST(n_lines AS DOUBLE) AS avg_revenue_per_stop,
         CAST(sum_rev AS DOUBLE) AS total_revenue,
         CAST(disposal_d AS DOUBLE) AS disposal_cost,
         CAST(fuel_d AS DOUBLE) AS fuel_cost,
         CAST(labour_d AS DOUBLE) AS labour_cost,
         CAST(maint_d AS DOUBLE) AS maintenance_cost,
         CAST(admin_d AS DOUBLE) AS admin_cost,
         CAST(cost_d AS DOUBLE) AS total_cost,
         CAST(sum_rev - disposal_d AS DOUBLE) AS net_revenue,
         CAST(sum_rev - cost_d AS DOUBLE) AS gross_profit,
         """ + sdiv("CAST(sum_rev - cost_d AS DOUBLE)", "CAST(sum_rev AS DOUBLE)") + """ * 100
           AS gross_margin_pct,
         CAST(lh_d AS DOUBLE) AS scheduled_hours,
         CAST(lh_d + 0.25 * n_missed AS DOUBLE) AS actual_hours,
         CAST(n_missed * 15 AS INTEGER) AS delay_minutes,
         CAST(CASE WHEN n_missed = 0 THEN 1 ELSE 0 END AS INTEGER) AS on_time_flag,
         CAST(incident AS INTEGER) AS incident_flag,
         CASE WHEN incident = 0 THEN 'None'
              WHEN min_status = 'F' THEN 'Spill'
              WHEN min_status = 'O' THEN 'Near-Miss' END AS incident_type
  FROM rd_cost
)"""


def _ratios(lines: str) -> str:
    """``name = numerator / denominator`` lines as select items."""
    out = []
    for line in lines.strip().splitlines():
        name, ratio = line.strip().split(" = ")
        out.append("{} AS {}".format(sdiv(*ratio.split(" / ")), name))
    return ",\n         ".join(out)


DAY_RATIOS = """
revenue_per_completed_stop = total_revenue / completed_stops
cost_per_completed_stop = total_cost / completed_stops
profit_per_completed_stop = gross_profit / completed_stops
revenue_per_km = total_revenue / total_distance_km
cost_per_km = total_cost / total_distance_km
profit_per_km = gross_profit / total_distance_km
fuel_litres_per_100km = total_fuel_used_litres * 100 / total_distance_km
stops_per_labour_hour = completed_stops / total_labour_hours
revenue_per_tonne = total_revenue / total_tonnes
cost_per_tonne = total_cost / total_tonnes
profit_per_tonne = gross_profit / total_tonnes
disposal_cost_per_tonne = disposal_cost / total_tonnes
completion_rate = completed_stops / total_stops
missed_stop_rate = missed_stops / total_stops
disposal_cost_share = disposal_cost / total_cost
fuel_cost_share = fuel_cost / total_cost
labour_cost_share = labour_cost / total_cost
maintenance_cost_share = maintenance_cost / total_cost
admin_cost_share = admin_cost / total_cost
"""
MONTH_RATIOS = """
revenue_per_completed_stop = total_revenue / completed_stops
cost_per_completed_stop = total_cost / completed_stops
profit_per_completed_stop = gross_profit / completed_stops
revenue_per_tonne = total_revenue / total_tonnes
cost_per_tonne = total_cost / total_tonnes
profit_per_tonne = gross_profit / total_tonnes
disposal_cost_per_tonne = disposal_cost / total_tonnes
fuel_litres_per_100km = total_fuel_used_litres * 100 / total_distance_km
stops_per_labour_hour = completed_stops / total_labour_hours
completion_rate = completed_stops / total_stops
missed_stop_rate = missed_stops / total_stops
disposal_cost_share = disposal_cost / total_cost
fuel_cost_share = fuel_cost / total_cost
labour_cost_share = labour_cost / total_cost
maintenance_cost_share = maintenance_cost / total_cost
admin_cost_share = admin_cost / total_cost
pct_underperforming_days = underperforming_days / n_route_days
"""
MONTH_SUMS = """total_revenue total_cost net_revenue gross_profit disposal_cost fuel_cost labour_cost
maintenance_cost admin_cost total_tonnes total_yards total_distance_km total_fuel_used_litres
total_labour_hours""".split()
SOURCE = """route_date_key date year month quarter day_of_week region bu area route_id
primary_waste_stream primary_customer_segment num_drivers num_trucks total_stops completed_stops
missed_stops total_distance_km total_fuel_used_litres total_labour_hours total_yards total_tonnes
avg_revenue_per_stop total_revenue disposal_cost fuel_cost labour_cost maintenance_cost admin_cost
total_cost net_revenue gross_profit gross_margin_pct scheduled_hours actual_hours delay_minutes
on_time_flag incident_flag incident_type""".split()
FACT_TYPES = {
    "string": "route_id quarter region bu area", "int": "year month",
    "bigint": "n_route_days completed_stops total_stops missed_stops incident_days underperforming_days",
    "boolean": "month_underperforming_flag"}
FACT = ["route_id", "year", "month", "quarter", "region", "bu", "area", "n_route_days", *MONTH_SUMS,
        "completed_stops", "total_stops", "missed_stops", "incident_days", "underperforming_days",
        "weighted_gross_margin_pct", *(x.split(" = ")[0] for x in MONTH_RATIOS.split("\n") if x),
        "month_underperforming_flag"]


def kth_sql(source: str, col: str, q: float) -> str:
    """Scalar subquery: element of rank ceil(q*n) among non-null values."""
    return (
        f"(SELECT v FROM (SELECT {col} AS v, row_number() OVER (ORDER BY {col}) AS rn "
        f"FROM {source} WHERE {col} IS NOT NULL) "
        f"WHERE rn = (SELECT greatest(CAST(ceil(CAST({q!r} AS DOUBLE) * count(*)) AS BIGINT), 1) "
        f"FROM {source} WHERE {col} IS NOT NULL))"
    )


SILVER = ROUTE_DAYS + """,
silver_base AS (
  SELECT * REPLACE (nullif(incident_type, 'None') AS incident_type),
         """ + _ratios(DAY_RATIOS) + """
  FROM route_days
),
thr AS (
  SELECT CAST(coalesce(round_even(""" + kth_sql("silver_base", "gross_margin_pct", 0.1) + """, 0),
                       10.0) AS DOUBLE) AS t
),
flagged AS (
  SELECT b.*, b.gross_margin_pct < (SELECT t FROM thr) AS underperforming_flag,
         CASE WHEN b.gross_margin_pct < (SELECT t FROM thr) THEN
           'margin ' || CAST(round(b.gross_margin_pct, 1) + 0.0 AS VARCHAR)
           || '% < ' || CAST(CAST((SELECT t FROM thr) AS BIGINT) AS VARCHAR) || '%'
           || CASE WHEN b.gross_profit < 0 THEN '; negative gross profit' ELSE '' END
           || CASE WHEN b.disposal_cost_share > 0.40 THEN '; disposal-heavy (>40% of cost)' ELSE '' END
           || CASE WHEN b.completion_rate < 0.90 THEN '; low completion (<90%)' ELSE '' END
           || CASE WHEN b.fuel_cost_share > 0.30 THEN '; fuel-heavy (>30% of cost)' ELSE '' END
         END AS underperformance_reason
  FROM silver_base b
),
route_stats AS (
  SELECT route_id,
         """ + wpct("gross_profit", "total_revenue") + """ AS route_weighted_margin_pct,
         """ + sdiv("sum(CAST(underperforming_flag AS INTEGER))", "count(*)") + """
           AS route_pct_days_under
  FROM flagged GROUP BY route_id
),
routes AS (
  SELECT rs.*, (rs.route_weighted_margin_pct < (SELECT t FROM thr)) OR (rs.route_pct_days_under >= 0.20)
           AS route_persistent_underperformer
  FROM route_stats rs
),
silver AS (
  SELECT f.*, r.route_weighted_margin_pct, r.route_pct_days_under,
         r.route_persistent_underperformer
  FROM flagged f LEFT JOIN routes r ON f.route_id = r.route_id
)"""


def _gold_sql() -> str:
    sums = ["count(*) AS n_route_days"]
    sums += [f"{xsum(c)} AS {c}" for c in MONTH_SUMS]
    sums += [f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("completed_stops", "total_stops", "missed_stops")]
    sums += ["CAST(sum(incident_flag) AS BIGINT) AS incident_days",
             "CAST(sum(CAST(underperforming_flag AS INTEGER)) AS BIGINT) AS underperforming_days"]
    ratios = [f"{sdiv('gross_profit', 'total_revenue')} * 100 AS weighted_gross_margin_pct", _ratios(MONTH_RATIOS)]
    return (
        ",\ngold_sums AS (\n  SELECT route_id, year, month, quarter, region, bu, area,\n         "
        + ",\n         ".join(sums)
        + "\n  FROM silver GROUP BY route_id, year, month, quarter, region, bu, area\n),\n"
        + "gold_r AS (\n  SELECT g.*,\n         " + ",\n         ".join(ratios)
        + "\n  FROM gold_sums g\n),\n"
        + "gold AS (\n  SELECT gold_r.*, gold_r.weighted_gross_margin_pct < (SELECT t FROM thr) "
        + "AS month_underperforming_flag\n  FROM gold_r\n)"
    )


GOLD = SILVER + _gold_sql()

DIMS = GOLD + """,
dim_route AS (SELECT DISTINCT route_id, region, bu, area FROM silver),
dim_date AS (
  SELECT DISTINCT year * 100 + month AS date_month_key, year, month, quarter,
         make_date(year, month, 1) AS month_start_date
  FROM silver
)"""


def with_ctes(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


def twins() -> dict[str, str]:
    """Query name → DuckDB SQL."""
    q: dict[str, str] = {}
    R, S, G, D = ROUTE_DAYS, SILVER, GOLD, DIMS

    q["route_day_feed"] = with_ctes(R, "SELECT * FROM route_days")

    # --- B: data quality on the feed -------------------------------------
    q["bronze_dq_summary"] = with_ctes(R, """
SELECT count(*) AS row_count,
       count(*) FILTER (WHERE completed_stops > total_stops) AS completed_gt_total,
       count(*) FILTER (WHERE total_revenue < 0) AS negative_total_revenue,
       count(*) FILTER (WHERE net_revenue < 0) AS negative_net_revenue,
       count(*) FILTER (WHERE incident_type = 'None') AS sentinel_none,
       count(*) FILTER (WHERE incident_type IS NULL) AS true_nulls,
       count(*) FILTER (WHERE (incident_flag = 1 AND (incident_type IS NULL OR incident_type = 'None'))
                          OR (incident_flag = 0 AND NOT (incident_type IS NULL OR incident_type = 'None')))
         AS flag_type_mismatch,
       count(nullif(incident_type, 'None')) AS incident_type_non_null_normalised
FROM route_days""")
    q["bronze_null_counts"] = with_ctes(R, "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count "
        f"FROM route_days" for c in SOURCE if c != 'incident_type'))
    q["bronze_duplicate_keys"] = with_ctes(R, """
SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys,
       count(*) FILTER (WHERE n > 1) AS duplicate_keys
FROM (SELECT route_date_key, count(*) AS n FROM route_days GROUP BY route_date_key)""")
    q["lineitem_duplicate_keys"] = """
SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys,
       count(*) FILTER (WHERE n > 1) AS duplicate_keys
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
      GROUP BY l_orderkey, l_linenumber)"""
    q["partition_inventory"] = with_ctes(R, """
SELECT DISTINCT year, month FROM route_days ORDER BY year, month""")

    # --- C: Silver --------------------------------------------------------
    q["dedupe_latest"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
             l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
             l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
             l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1"""
    q["sentinel_normalised"] = with_ctes(S, """
SELECT route_date_key, incident_flag, incident_type FROM silver_base""")
    key = "route_date_key"
    q["silver_per_stop"] = with_ctes(S, f"""
SELECT {key}, revenue_per_completed_stop, cost_per_completed_stop, profit_per_completed_stop
FROM silver_base""")
    q["silver_density"] = with_ctes(S, f"""
SELECT {key}, revenue_per_km, cost_per_km, profit_per_km, fuel_litres_per_100km,
       stops_per_labour_hour FROM silver_base""")
    q["silver_tonne"] = with_ctes(S, f"""
SELECT {key}, revenue_per_tonne, cost_per_tonne, profit_per_tonne, disposal_cost_per_tonne
FROM silver_base""")
    q["silver_health"] = with_ctes(S, f"""
SELECT {key}, completion_rate, missed_stop_rate FROM silver_base""")
    q["silver_cost_shares"] = with_ctes(S, f"""
SELECT {key}, disposal_cost_share, fuel_cost_share, labour_cost_share, maintenance_cost_share,
       admin_cost_share FROM silver_base""")
    pcts = [("p10", 0.1), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9)]
    q["margin_profile"] = with_ctes(S, "\nSELECT " + ",\n       ".join(
        [f"round({kth_sql('silver_base', 'gross_margin_pct', p)}, 2) AS {nm}" for nm, p in pcts]
        + ["round(avg(gross_margin_pct), 2) AS mean",
           "round(min(gross_margin_pct), 2) AS min",
           "round(max(gross_margin_pct), 2) AS max",
           "count(*) AS n_rows",
           "count(*) FILTER (WHERE gross_profit < 0) AS n_negative_profit",
           f"round({sdiv('count(*) FILTER (WHERE gross_profit < 0) * 100', 'count(*)')}, 2) "
           "AS pct_negative_profit"])
        + "\nFROM silver_base")
    q["underperformance_threshold"] = with_ctes(S, """
SELECT t AS threshold,
       (SELECT count(*) FROM silver_base WHERE gross_margin_pct IS NOT NULL) AS n_values
FROM thr""")
    q["flagged_days"] = with_ctes(S, """
SELECT route_date_key, gross_margin_pct FROM flagged WHERE underperforming_flag""")
    q["flagged_examples"] = with_ctes(S, """
SELECT route_date_key, gross_margin_pct, underperformance_reason FROM flagged
WHERE underperforming_flag""")
    q["underperformance_reason"] = with_ctes(S, """
SELECT route_date_key, underperforming_flag, underperformance_reason FROM flagged""")
    q["route_windows"] = with_ctes(S, """
SELECT route_date_key, route_id, route_weighted_margin_pct, route_pct_days_under,
       route_persistent_underperformer FROM silver""")
    q["persistent_routes"] = with_ctes(S, """
SELECT DISTINCT route_id, region, bu, area, route_weighted_margin_pct, route_pct_days_under
FROM silver WHERE route_persistent_underperformer
ORDER BY route_weighted_margin_pct, route_id""")
    q["rule_counts"] = with_ctes(S, f"""
SELECT count(*) AS route_days,
       count(*) FILTER (WHERE underperforming_flag) AS underperforming_days,
       round({sdiv('count(*) FILTER (WHERE underperforming_flag) * 100', 'count(*)')}, 2)
         AS pct_underperforming_days,
       count(DISTINCT route_id) AS routes,
       count(DISTINCT CASE WHEN route_persistent_underperformer THEN route_id END)
         AS persistent_routes,
       round({sdiv('count(DISTINCT CASE WHEN route_persistent_underperformer THEN route_id END) * 100',
                   'count(DISTINCT route_id)')}, 2) AS pct_persistent_routes
FROM silver""")

    # --- D: Gold and star -------------------------------------------------
    q["gold_sums"] = with_ctes(G, "\nSELECT * FROM gold_sums")
    q["gold_ratios"] = with_ctes(G, "\nSELECT * FROM gold")
    q["gold_grain_check"] = with_ctes(G, """
SELECT count(*) AS fact_rows,
       (SELECT count(*) FROM (SELECT DISTINCT route_id, year, month FROM gold)) AS distinct_grain_keys
FROM gold""")
    q["geo_dependency_check"] = with_ctes(S, """
SELECT route_id, min(region) AS region_min, min(bu) AS bu_min, min(area) AS area_min,
       max(region) AS region_max, max(bu) AS bu_max, max(area) AS area_max
FROM silver GROUP BY route_id
HAVING count(DISTINCT region) > 1 OR count(DISTINCT bu) > 1 OR count(DISTINCT area) > 1
    OR (count(region) > 0 AND count(region) < count(*))
    OR (count(bu) > 0 AND count(bu) < count(*))
    OR (count(area) > 0 AND count(area) < count(*))""")
    q["dim_route"] = with_ctes(D, "\nSELECT * FROM dim_route ORDER BY route_id, region, bu, area")
    q["dim_date"] = with_ctes(D, "\nSELECT * FROM dim_date ORDER BY date_month_key, quarter")
    q["star_slice_region_quarter"] = with_ctes(D, f"""
SELECT r.region, d.quarter, count(*) AS route_months,
       CAST(sum(g.n_route_days) AS BIGINT) AS route_days,
       {xsum('g.total_revenue')} AS total_revenue,
       {xsum('g.gross_profit')} AS gross_profit,
       round({sdiv(xsum('g.gross_profit'), xsum('g.total_revenue'))} * 100, 2) AS weighted_margin
FROM gold g JOIN dim_route r ON g.route_id = r.route_id
JOIN dim_date d ON g.year = d.year AND g.month = d.month
GROUP BY r.region, d.quarter ORDER BY r.region, d.quarter""")

    # --- E: analysis ------------------------------------------------------
    def hier_sql(col: str, limit: int | None = None) -> str:
        lim = f" LIMIT {limit}" if limit else ""
        return with_ctes(S, f"""
SELECT {col}, count(*) AS days,
       round({sdiv('sum(CAST(underperforming_flag AS INTEGER))', 'count(*)')} * 100, 1) AS under_pct,
       round({wpct('gross_profit', 'total_revenue')}, 2) AS weighted_margin
FROM silver GROUP BY {col}
ORDER BY weighted_margin NULLS FIRST, {col}{lim}""")

    q["hier_bu"] = hier_sql("bu")
    q["hier_area_worst10"] = hier_sql("area", 10)
    q["hier_region"] = hier_sql("region")
    q["hier_route"] = hier_sql("route_id")
    q["hier_all_levels"] = with_ctes(S, f"""
SELECT CASE WHEN grouping(region) = 0 THEN 'region' WHEN grouping(bu) = 0 THEN 'bu' WHEN grouping(area) = 0 THEN 'area'
            WHEN grouping(route_id) = 0 THEN 'route_id' ELSE 'fleet' END AS level,
       coalesce(region, bu, area, route_id) AS "key", count(*) AS days,
       round({sdiv('sum(CAST(underperforming_flag AS INTEGER))', 'count(*)')} * 100, 1) AS under_pct,
       round({wpct('gross_profit', 'total_revenue')}, 2) AS weighted_margin
FROM silver GROUP BY GROUPING SETS ((region), (bu), (area), (route_id), ())""")
    q["cost_drivers"] = with_ctes(S, """
SELECT underperforming_flag,
       round(avg(disposal_cost_share), 3) AS disposal_share,
       round(avg(fuel_cost_share), 3) AS fuel_share,
       round(avg(labour_cost_share), 3) AS labour_share,
       round(avg(maintenance_cost_share), 3) AS maintenance_share,
       round(avg(admin_cost_share), 3) AS admin_share,
       round(avg(revenue_per_completed_stop), 2) AS revenue_per_stop,
       round(avg(cost_per_completed_stop), 2) AS cost_per_stop,
       round(avg(disposal_cost_per_tonne), 2) AS disposal_per_tonne,
       round(avg(completion_rate), 3) AS completion_rate
FROM silver GROUP BY underperforming_flag ORDER BY underperforming_flag NULLS FIRST""")
    specs = [("disposal_share", "disposal_cost_share", 3),
             ("disposal_per_tonne", "disposal_cost_per_tonne", 2),
             ("revenue_per_stop", "revenue_per_completed_stop", 2),
             ("cost_per_stop", "cost_per_completed_stop", 2),
             ("completion_rate", "completion_rate", 3)]
    cols = []
    for name, c, nd in specs:
        u = f"round(avg(CASE WHEN underperforming_flag THEN {c} END), {nd})"
        h = f"round(avg(CASE WHEN NOT underperforming_flag THEN {c} END), {nd})"
        cols += [f"{u} AS {name}_under", f"{h} AS {name}_healthy",
                 f"round({u} - {h}, {nd}) AS {name}_delta"]
    q["driver_deltas"] = with_ctes(S, "\nSELECT " + ",\n       ".join(cols) + "\nFROM silver")
    q["waste_stream_margin"] = with_ctes(S, f"""
SELECT primary_waste_stream,
       round({wpct('gross_profit', 'total_revenue')}, 2) AS weighted_margin,
       round(avg(disposal_cost_per_tonne), 2) AS disposal_per_tonne
FROM silver GROUP BY primary_waste_stream
ORDER BY weighted_margin NULLS FIRST, primary_waste_stream""")
    trend = f"""
SELECT year,
       round({wpct('gross_profit', 'total_revenue')}, 2) AS weighted_margin,
       round({sdiv(xsum('gross_profit'), 'sum(completed_stops)')}, 2) AS profit_per_stop,
       round({sdiv(xsum('disposal_cost'), xsum('total_tonnes'))}, 2) AS disposal_per_tonne,
       round({sdiv('sum(CAST(month_underperforming_flag AS INTEGER))', 'count(*)')} * 100, 1)
         AS under_month_pct
FROM gold GROUP BY year"""
    q["yearly_trend"] = with_ctes(G, trend + " ORDER BY year")
    q["trend_direction"] = with_ctes(G + ",\ntrend AS (" + trend + "\n)", """
SELECT min(year) AS first_year, max(year) AS last_year,
       round(arg_max(weighted_margin, year) - arg_min(weighted_margin, year), 2) AS margin_change,
       round(arg_max(profit_per_stop, year) - arg_min(profit_per_stop, year), 2)
         AS profit_per_stop_change,
       CASE WHEN round(arg_max(weighted_margin, year) - arg_min(weighted_margin, year), 2) > 0
            THEN 'IMPROVING' ELSE 'DETERIORATING' END AS direction
FROM trend""")
    q["fleet_totals"] = with_ctes(S, f"""
SELECT {xsum('total_revenue')} AS total_revenue, {xsum('total_cost')} AS total_cost,
       {xsum('gross_profit')} AS gross_profit,
       round({wpct('gross_profit', 'total_revenue')}, 2) AS weighted_margin
FROM silver""")
    q["worst_pockets"] = with_ctes(S, f"""
SELECT area, primary_customer_segment, count(*) AS days,
       round({wpct('gross_profit', 'total_revenue')}, 2) AS weighted_margin,
       round(avg(disposal_cost_per_tonne), 2) AS disposal_per_tonne,
       round(avg(revenue_per_completed_stop), 2) AS revenue_per_stop
FROM silver GROUP BY area, primary_customer_segment
HAVING count(*) >= 30
ORDER BY weighted_margin NULLS FIRST, area, primary_customer_segment LIMIT 10""")
    q["route_drilldown"] = with_ctes(S + f""",
worst AS (
  SELECT route_id FROM silver GROUP BY route_id
  ORDER BY {wpct('gross_profit', 'total_revenue')} NULLS LAST, route_id LIMIT 1
)""", """
SELECT s.route_date_key, s.date, s.route_id, s.bu, s.area, s.gross_margin_pct,
       s.underperforming_flag, s.underperformance_reason, s.disposal_cost_per_tonne,
       s.revenue_per_completed_stop
FROM silver s JOIN worst w ON s.route_id IS NOT DISTINCT FROM w.route_id""")
    q.update(storage_twins())
    return q


def _interleave_sql(cols: list[str], bits: int) -> str:
    terms = []
    pos = bits * len(cols) - 1
    for b in range(bits - 1, -1, -1):
        for c in cols:
            terms.append(f"(((({c}) >> {b}) & 1) << {pos})")
            pos -= 1
    return "(" + " | ".join(terms) + ")"


def storage_twins() -> dict[str, str]:
    q: dict[str, str] = {}
    base_ts, restate_ts, rerun_ts = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
    end, frm = "(SELECT base_end FROM dates)", "(SELECT restate_from FROM dates)"
    restated = f"date < {end}"
    disp = "disposal_cost * CAST(1.1 AS DOUBLE)"
    cost = f"(total_cost - disposal_cost + {disp})"
    scen = ROUTE_DAYS + f""",
dates AS (SELECT min(date) + CAST((max(date) - min(date)) * 3 // 4 AS INTEGER) AS base_end,
                 min(date) + CAST((max(date) - min(date)) // 2 AS INTEGER) AS restate_from FROM route_days),
base AS (SELECT * FROM route_days WHERE date < {end}),
batch AS (
  SELECT * REPLACE (
    CASE WHEN {restated} THEN {disp} ELSE disposal_cost END AS disposal_cost,
    CASE WHEN {restated} THEN {cost} ELSE total_cost END AS total_cost,
    CASE WHEN {restated} THEN total_revenue - {disp} ELSE net_revenue END AS net_revenue,
    CASE WHEN {restated} THEN total_revenue - {cost} ELSE gross_profit END AS gross_profit,
    CASE WHEN {restated} THEN {sdiv(f'total_revenue - {cost}', 'total_revenue')} * 100
         ELSE gross_margin_pct END AS gross_margin_pct)
  FROM route_days WHERE date >= {frm}
)"""
    cols = ", ".join(SOURCE)
    q["upsert_result"] = with_ctes(scen, f"""
SELECT {cols}, '{rerun_ts}' AS load_ts FROM batch
UNION ALL
SELECT {cols}, '{base_ts}' AS load_ts FROM base
WHERE route_date_key NOT IN (SELECT route_date_key FROM batch)""")
    values = ", ".join(c for c in SOURCE if c != "route_date_key")
    states = scen + f""",
loads AS (
  SELECT {cols}, '{base_ts}' AS ts FROM base
  UNION ALL SELECT {cols}, '{restate_ts}' FROM batch
  UNION ALL SELECT {cols}, '{rerun_ts}' FROM batch),
news AS (
  SELECT * FROM (
    SELECT *, lag(ts) OVER k AS ts_before, lag(row({values})) OVER k AS before, row({values}) AS now
    FROM loads WINDOW k AS (PARTITION BY route_date_key ORDER BY ts))
  WHERE ts_before IS NULL OR before IS DISTINCT FROM now),
states AS (
  SELECT {cols}, ts AS valid_from, lead(ts) OVER (PARTITION BY route_date_key ORDER BY ts) AS valid_to FROM news)"""
    q["history_intervals"] = with_ctes(states, "\nSELECT * FROM states")
    q["snapshot_as_of_range"] = with_ctes(states, f"""
SELECT * FROM states WHERE valid_from <= '{restate_ts}' AND (valid_to IS NULL OR valid_to > '{restate_ts}')""")
    q["evolved_rows"] = with_ctes(scen, f"""
SELECT 'first' AS load_id, * REPLACE (CAST(delay_minutes AS BIGINT) AS delay_minutes, CAST(total_stops AS DOUBLE) AS total_stops),
       CAST(NULL AS DOUBLE) AS recycled_tonnes
FROM route_days WHERE date < {end}
UNION ALL BY NAME
SELECT 'second' AS load_id, * EXCLUDE (day_of_week) REPLACE (CAST(delay_minutes AS BIGINT) AS delay_minutes,
       CAST(total_stops AS DOUBLE) AS total_stops), total_tonnes * CAST(0.25 AS DOUBLE) AS recycled_tonnes
FROM route_days WHERE date >= {end}""")
    q["schema_changes"] = with_ctes(scen, f"""
SELECT 'first' AS load_id, 'delay_minutes' AS "column", 'int' AS load_type, 'bigint' AS merged_type, 'widened' AS change,
       count(delay_minutes) AS non_null FROM route_days WHERE date < {end}
UNION ALL SELECT 'first', 'total_stops', 'int', 'double', 'widened', count(total_stops) FROM route_days WHERE date < {end}
UNION ALL SELECT 'first', 'recycled_tonnes', NULL, 'double', 'missing', 0
UNION ALL SELECT 'second', 'day_of_week', NULL, 'string', 'missing', 0
UNION ALL SELECT 'second', 'recycled_tonnes', 'double', 'double', 'added', count(total_tonnes) FROM route_days WHERE date >= {end}""")
    # the textbook form: Gold rebuilt whole from the table after the restatement
    after = scen + f""",
restated_days AS (
  SELECT {cols} FROM batch
  UNION ALL
  SELECT {cols} FROM base WHERE route_date_key NOT IN (SELECT route_date_key FROM batch))"""
    q["gold_incremental"] = with_ctes(after + lossless(GOLD[len(ROUTE_DAYS):]).replace("FROM route_days", "FROM restated_days"),
                                      "\nSELECT * FROM gold")
    q["threshold_from_sketches"] = with_ctes(after, f"""
SELECT CAST(coalesce(round_even({kth_sql('restated_days', 'gross_margin_pct', 0.1)}, 0), 10.0) AS DOUBLE) AS threshold,
       count(gross_margin_pct) AS n_values FROM restated_days""")
    q["load_audit"] = with_ctes(scen, f"""
SELECT 'base' AS batch_id, 'CREATE' AS operation, '{base_ts}' AS load_ts, count(*) AS rows_in, count(*) AS inserted,
       CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS unchanged,
       count(DISTINCT (year, month)) AS partitions_touched FROM base
UNION ALL
SELECT 'restatement', 'MERGE', '{restate_ts}', count(*), count(*) FILTER (WHERE date >= {end}),
       count(*) FILTER (WHERE date < {end}), 0, count(DISTINCT (year, month)) FROM batch
UNION ALL
SELECT 'rerun', 'MERGE', '{rerun_ts}', count(*), 0, 0, count(*), count(DISTINCT (year, month)) FROM batch""")
    q["distinct_from_sketches"] = with_ctes(ROUTE_DAYS, """
SELECT 'route_date_key' AS "key", count(DISTINCT (year, month)) AS partitions, count(*) AS row_count,
       count(DISTINCT route_date_key) AS distinct_exact, true AS within_bounds FROM route_days
UNION ALL
SELECT 'route_month', count(DISTINCT (year, month)), count(*), count(DISTINCT (route_id, year, month)), true FROM route_days""")
    q["null_offenders"] = with_ctes(ROUTE_DAYS, "SELECT * FROM (" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM route_days"
        for c in SOURCE if c != "incident_type") + ") WHERE null_count > 0")
    q["csv_load_readback"] = with_ctes(ROUTE_DAYS, """
SELECT count(*) AS row_count, count(DISTINCT route_date_key) AS distinct_keys,
       count(*) - count(DISTINCT route_date_key) AS duplicate_keys,
       count(DISTINCT (year, month)) AS partitions FROM route_days""")
    q["snapshot_as_of"] = with_ctes(scen, f"""
SELECT {cols}, '{base_ts}' AS load_ts FROM base""")
    changed = ", ".join(
        f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END"
        for c in SOURCE if c != "route_date_key") + \
        ", CASE WHEN o.ts IS DISTINCT FROM n.ts THEN 'ingestion_ts' END"
    q["snapshot_diff"] = with_ctes(scen + f""",
old_v AS (SELECT *, TIMESTAMP '{base_ts}' AS ts FROM base),
new_v AS (
  SELECT *, TIMESTAMP '{restate_ts}' AS ts FROM batch
  UNION ALL
  SELECT *, TIMESTAMP '{base_ts}' AS ts FROM base
  WHERE route_date_key NOT IN (SELECT route_date_key FROM batch)
)""", f"""
SELECT n.route_date_key, 'added' AS change, CAST(NULL AS VARCHAR) AS changed_columns
FROM new_v n WHERE n.route_date_key NOT IN (SELECT route_date_key FROM old_v)
UNION ALL
SELECT o.route_date_key, 'removed', CAST(NULL AS VARCHAR)
FROM old_v o WHERE o.route_date_key NOT IN (SELECT route_date_key FROM new_v)
UNION ALL
SELECT * FROM (
  SELECT o.route_date_key, 'changed' AS change, concat_ws(',', {changed}) AS changed_columns
  FROM old_v o JOIN new_v n ON o.route_date_key = n.route_date_key
) WHERE changed_columns <> ''""")
    q["contract_roundtrip"] = with_ctes(ROUTE_DAYS, f"""
SELECT *, true AS has_source_file, '{base_ts}' AS load_ts FROM route_days""")
    kind = {c: t for t, names in FACT_TYPES.items() for c in names.split()}
    tables = {"fact_route_month_profitability": ("gold", [(c, kind.get(c, "double")) for c in FACT]),
              "dim_route": ("dim_route", [(c, "string") for c in ("route_id", "region", "bu", "area")]),
              "dim_date": ("dim_date", [("date_month_key", "int"), ("year", "int"), ("month", "int"),
                                        ("quarter", "string"), ("month_start_date", "date")])}
    q["contract_schema_check"] = with_ctes(DIMS, "\nUNION ALL\n".join(
        f"SELECT '{table}' AS \"table\", CAST({k} AS INTEGER) AS position, '{c}' AS \"column\", "
        f"'{t}' AS expected_type, '{t}' AS actual_type, 'ok' AS status, count({c}) AS non_null FROM {cte}"
        for table, (cte, fields) in tables.items() for k, (c, t) in enumerate(fields)))

    bits = 63 // 3
    zcols = ["bu", "area", "route_id"]
    ords = []
    for i, c in enumerate(zcols):
        ords.append(f"""
o{i} AS (
  SELECT v, CASE WHEN total > {1 << bits} THEN CAST(trunc(r * {1 << bits} / total) AS BIGINT)
                 ELSE r END AS ord
  FROM (SELECT v, dense_rank() OVER (ORDER BY v NULLS FIRST) - 1 AS r, count(*) OVER () AS total
        FROM (SELECT DISTINCT {c} AS v FROM silver))
)""")
    zexpr = _interleave_sql(["o0.ord", "o1.ord", "o2.ord"], bits)
    q["zorder_rows"] = with_ctes(SILVER + "," + ",".join(ords), f"""
SELECT s.route_date_key, s.year, s.region, s.bu, s.area, s.route_id, {zexpr} AS zorder_key
FROM silver s
JOIN o0 ON s.bu IS NOT DISTINCT FROM o0.v
JOIN o1 ON s.area IS NOT DISTINCT FROM o1.v
JOIN o2 ON s.route_id IS NOT DISTINCT FROM o2.v""")
    q["clustered_rows"] = with_ctes(SILVER, """
SELECT route_date_key, year, region, bu, area, route_id, gross_margin_pct, underperforming_flag,
       route_weighted_margin_pct, route_pct_days_under, route_persistent_underperformer
FROM silver""")
    q["compacted_rows"] = with_ctes(SILVER, """
SELECT route_date_key, year, region, gross_margin_pct, underperforming_flag FROM silver""")
    q["pruned_slice"] = with_ctes(GOLD, "\nSELECT * FROM gold WHERE region = 'EUROPE'")
    return q
