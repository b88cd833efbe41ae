"""Route-day records derived from the TPC-H-shaped input tables.

The reference's raw CSV is not available, so the route-day feed is derived
from ``lineitem`` and its dimensions: one supplier is one route, one ship
date is one route day. The derivation is a single distributed plan:

    lineitem ⋈ part ⋈ (orders ⋈ customer)      -- line grain, shuffle joins
      → aggregate by (supplier, ship date), dealt by supplier and month
      ⋈ supplier ⋈ nation ⋈ region              -- route-day grain
      → the 39 columns, a projection

The supplier/nation/region joins happen *after* the aggregate, so they see
route-days, not line items. No side is broadcast on trust: the planner
broadcasts a side only when its measured size is under the broadcast
threshold (``nation`` and ``region`` always are) and shuffle-joins
otherwise, with AQE splitting skewed join partitions.

The aggregate holds only fixed-width buffers (a hash aggregate): string
minimums are taken over order-preserving dictionary codes and decoded
afterwards. Plans that read the feed more than once store the narrow
aggregate (``route_day_sums``) and project it anew on each read.

Money and quantities are summed as decimals and cast to double once at the
end: decimal sums are exact and independent of summation order, which makes
the output bit-identical across engines and partitionings.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwise.functions.metrics import safe_div
from haulwise.sources.contract import SOURCE_COLUMNS
from haulwise.sources.layout import ordinals
from haulwise.sources.tables import read_input

# Fixed values of the mapping (decimal types of the line measures).
QTY = "decimal(6,2)"
PRICE = "decimal(12,2)"
DISC = "decimal(4,2)"
RETAIL = "decimal(8,2)"
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
# What :func:`route_day_sums` returns.
SUM_COLUMNS = ("k", "date", "n_lines", "n_completed", "n_missed", "sum_size", "sum_qty", "sum_rev",
               "sum_qty_retail", "incident", "status", "p_type", "c_mktsegment", "n_name", "r_name")


def _d(x: str) -> Column:
    return F.lit(Decimal(x))


def disposal_rate(k: Column) -> Column:
    """Per-route tipping rate (decimal(4,2)) as a function of the route key:
    0.20 + 0.05*(k mod 4), plus 2.00 when k mod 50 = 3, else 0.50 when
    k mod 7 = 3."""
    surcharge = (F.when(k % 50 == 3, _d("2.00"))
                 .when(k % 7 == 3, _d("0.50"))
                 .otherwise(_d("0.00")))
    return (_d("0.20") + _d("0.05") * (k % 4) + surcharge).cast(DISC)


def dictionary(values: DataFrame, col: str, code: str) -> DataFrame:
    """Order-preserving dictionary of a string column: ``(col, code)`` with
    ``code`` the value's rank among the distinct non-null values, so
    ``min(code)`` decodes to ``min(col)``. The rank is distributed
    (``layout.ordinals``: no single-task sort, nothing on the driver), and no
    job starts while the query is being built; the planner broadcasts the
    dictionary when its measured size is small."""
    distinct = values.select(col).where(F.col(col).isNotNull()).distinct()
    return ordinals(distinct, [col]).select(F.col("c0").alias(col), F.col("ord").alias(code))


# A line's two status letters and whether its discount is 0.10 as
# one number, (discount) * 18 + (line status) * 3 + (return flag); 0 stands for
# null in any.
RETURNED, OTHER_RETURN, TENTH_OFF = 1, 2, 18
BELOW_F, IS_F, BETWEEN, IS_O, ABOVE_O = 1, 2, 3, 4, 5


def _marks() -> Column:
    flag = (F.when(F.col("l_returnflag") == "R", RETURNED)
            .when(F.col("l_returnflag").isNotNull(), OTHER_RETURN).otherwise(0))
    s = F.col("l_linestatus")
    status = (F.when(s < "F", BELOW_F).when(s == "F", IS_F).when(s < "O", BETWEEN)
              .when(s == "O", IS_O).when(s.isNotNull(), ABOVE_O).otherwise(0))
    tenth = F.when(F.col("l_discount").cast(DISC) == _d("0.10"), TENTH_OFF).otherwise(0)
    return (tenth + status * 3 + flag).cast("int")


def line_items(spark: SparkSession, sf_dir: str, part_dict: DataFrame,
               seg_dict: DataFrame) -> DataFrame:
    """Line grain with the part and customer attributes the mapping needs.

    Everything the aggregate asks of a line is brought to its fixed-width form
    at the scan (measures as decimals, revenue as one, the marks as a number, string
    attributes as dictionary codes attached to the ``part`` and ``customer``
    rows), so each of the three shuffles of lines carries few bytes a row."""
    li = read_input(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_suppkey").alias("k"),
        F.to_date("l_shipdate").alias("date"), F.col("l_quantity").cast(QTY).alias("q"),
        (F.col("l_extendedprice").cast(PRICE) * (F.lit(1) - F.col("l_discount").cast(DISC))).alias("rev"),
        _marks().alias("marks"))
    part = read_input(spark, sf_dir, "part").select(
        "p_partkey", "p_type", "p_size", F.col("p_retailprice").cast(RETAIL).alias("rp"))
    part = part.join(part_dict, "p_type", "left").drop("p_type")
    orders = read_input(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = read_input(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    cust = cust.join(seg_dict, "c_mktsegment", "left")
    order_seg = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        "o_orderkey", "c_segment_code")
    # a shuffled part or order is much smaller than its lines: hashed, the lines
    # need not be sorted for either join
    return (
        li.join(part.hint("shuffle_hash"), li.l_partkey == part.p_partkey).drop("l_partkey", "p_partkey")
        .join(order_seg.hint("shuffle_hash"), F.col("l_orderkey") == order_seg.o_orderkey).drop("l_orderkey", "o_orderkey")
    )


def route_day_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per route-day with the sums, codes and names that
    :func:`feed_of` makes the feed's columns from: a fifth of their bytes, so
    this is the form to store or shuffle.

    Lines are dealt by route and month, which is finer than a route, so that a
    long route is spread, and keeps a route-month together, so that month sums
    are nearly done before they are shuffled."""
    part_dict = dictionary(read_input(spark, sf_dir, "part"), "p_type", "p_type_code")
    seg_dict = dictionary(read_input(spark, sf_dir, "customer"), "c_mktsegment",
                          "c_segment_code")
    lines = line_items(spark, sf_dir, part_dict, seg_dict)
    ym = F.year("date") * 12 + F.month("date")
    q = F.col("q")
    flag, status = F.col("marks") % 3, F.floor(F.col("marks") % TENTH_OFF / 3).cast("int")
    agg = (
        lines.repartition("k", ym).groupBy("k", ym.alias("ym"), "date")
        .agg(
            F.count(F.lit(1)).cast("int").alias("n_lines"),
            F.count_if(flag == OTHER_RETURN).cast("int").alias("n_completed"),
            F.count_if(flag == RETURNED).cast("int").alias("n_missed"),
            F.sum("p_size").alias("sum_size"),
            F.sum(q).alias("sum_qty"),
            F.sum("rev").alias("sum_rev"),
            F.sum(q * F.col("rp")).alias("sum_qty_retail"),
            F.max(F.when((flag == RETURNED) & (F.col("marks") >= TENTH_OFF), 1).otherwise(0))
            .alias("incident"),
            F.min("p_type_code").alias("p_type_code"),
            F.min("c_segment_code").alias("c_segment_code"),
            # nulls are ignored as min(l_linestatus) ignores them
            F.min(F.when(status > 0, status)).alias("status"),
        ).drop("ym")
    )
    agg = (agg.join(part_dict, "p_type_code", "left")
           .join(seg_dict, "c_segment_code", "left").drop("p_type_code", "c_segment_code"))

    supplier = read_input(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_input(spark, sf_dir, "nation").select(
        "n_nationkey", "n_name", "n_regionkey")
    region = read_input(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        agg.join(supplier, agg.k == supplier.s_suppkey)
        .join(nation, F.col("s_nationkey") == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
        .drop("s_suppkey", "s_nationkey", "n_nationkey", "n_regionkey", "r_regionkey")
    )


def route_id(k: Column) -> Column:
    """``RTE-%04d``; the formatter itself is slow and only used below zero."""
    digits = k.cast("string")
    return F.concat(F.lit("RTE-"), F.when((k >= 0) & (k < 10_000), F.lpad(digits, 4, "0")).when(k >= 10_000, digits)
                    .otherwise(F.format_string("%04d", k)))


def area(bu: Column, k: Column) -> Column:
    return F.concat(bu, F.lit("-"), (k % 2).cast("string"))


def day_key(k: Column, date: Column) -> Column:
    return F.concat(route_id(k), F.lit("_"), day_text(date))


def day_text(date: Column) -> Column:
    """``yyyy-MM-dd``: the cast where it writes the same (years of four digits),
    the slower formatter elsewhere."""
    plain = date.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date"))
    return F.when(plain, date.cast("string")).otherwise(F.date_format(date, "yyyy-MM-dd"))


def weekday(date: Column) -> Column:
    """The day's English name; a null date has none (``element_at`` alone would
    give one)."""
    name = F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.dayofweek(date))
    return F.when(date.isNotNull(), name)


def feed_of(sums: DataFrame) -> DataFrame:
    """The 39-column route-day feed (source contract order), a projection of
    :func:`route_day_sums`; other columns of ``sums`` are kept behind it."""
    k = F.col("k")
    cnt = F.col("n_lines")
    size = F.col("sum_size")
    rev = F.col("sum_rev")
    disposal = F.col("sum_qty_retail") * disposal_rate(k)
    fuel = size * 60
    labour = cnt * 400 + size * 10
    maint = size * 5
    admin = cnt * 150
    cost = disposal + fuel + labour + maint + admin
    labour_hours = _d("0.50") * cnt + _d("0.02") * size
    missed = F.col("n_missed")
    dbl = lambda c: c.cast("double")

    kept = [c for c in sums.columns if c not in SUM_COLUMNS]
    out = sums.select(
        day_key(k, F.col("date")).alias("route_date_key"),
        F.col("date"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.concat(F.lit("Q"), F.quarter("date")).alias("quarter"),
        weekday(F.col("date")).alias("day_of_week"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("bu"),
        area(F.col("n_name"), k).alias("area"),
        route_id(k).alias("route_id"),
        F.col("p_type").alias("primary_waste_stream"),
        F.col("c_mktsegment").alias("primary_customer_segment"),
        (F.lit(1) + k % 2).cast("int").alias("num_drivers"),
        F.lit(1).alias("num_trucks"),
        cnt.cast("int").alias("total_stops"),
        F.col("n_completed").cast("int").alias("completed_stops"),
        missed.cast("int").alias("missed_stops"),
        dbl(size).alias("total_distance_km"),
        dbl(size * _d("0.40")).alias("total_fuel_used_litres"),
        dbl(labour_hours).alias("total_labour_hours"),
        dbl(F.col("sum_qty") * _d("1.5")).alias("total_yards"),
        dbl(F.col("sum_qty")).alias("total_tonnes"),
        (dbl(rev) / dbl(cnt)).alias("avg_revenue_per_stop"),
        dbl(rev).alias("total_revenue"),
        dbl(disposal).alias("disposal_cost"),
        dbl(fuel).alias("fuel_cost"),
        dbl(labour).alias("labour_cost"),
        dbl(maint).alias("maintenance_cost"),
        dbl(admin).alias("admin_cost"),
        dbl(cost).alias("total_cost"),
        dbl(rev - disposal).alias("net_revenue"),
        dbl(rev - cost).alias("gross_profit"),
        (safe_div(dbl(rev - cost), dbl(rev)) * 100).alias("gross_margin_pct"),
        dbl(labour_hours).alias("scheduled_hours"),
        dbl(labour_hours + _d("0.25") * missed).alias("actual_hours"),
        (missed * 15).cast("int").alias("delay_minutes"),
        F.when(missed == 0, 1).otherwise(0).alias("on_time_flag"),
        F.col("incident").cast("int").alias("incident_flag"),
        F.when(F.col("incident") == 0, F.lit("None"))
        .when(F.col("status") == IS_F, F.lit("Spill"))
        .when(F.col("status") == IS_O, F.lit("Near-Miss"))
        .alias("incident_type"),
        *kept,
    )
    return out.select(*SOURCE_COLUMNS, *kept)


def route_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed straight from the input tables, for one pass over it."""
    return feed_of(route_day_sums(spark, sf_dir))
