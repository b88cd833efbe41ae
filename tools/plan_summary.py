"""Print the physical operators of the library's key plans (what
``explain("formatted")`` shows, condensed to one line per plan node)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from haulwise.operators import analysis, gold as gold_ops, silver as silver_ops  # noqa: E402
from haulwise.operators.dedupe import dedupe_latest  # noqa: E402
from haulwise.plans import medallion as M  # noqa: E402
from haulwise.session import local_session, scratch_path  # noqa: E402
from haulwise.sources import layout  # noqa: E402
from haulwise.sources.adapter import route_days  # noqa: E402
from haulwise.sources.tables import read_input  # noqa: E402


def _top_fields(schema: str) -> int:
    depth, n = 0, 1
    for ch in schema:
        if ch in "<(":
            depth += 1
        elif ch in ">)":
            depth -= 1
        elif ch == "," and depth == 0:
            n += 1
    return n


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    keep = []
    for line in plan.splitlines():
        m = re.match(r"^([\s:+\-|*]*)([A-Za-z]+)", line)
        if not m:
            continue
        name = m.group(2)
        extra = ""
        if name in ("Exchange",):
            extra = " " + line.split("Exchange", 1)[1].strip().split(",")[0][:60]
        if "FileScan" in line or name == "FileScan":
            rs = re.search(r"ReadSchema: struct<(.*)>", line)
            pf = re.search(r"PartitionFilters: \[(.*?)\]", line)
            extra = f" read_columns={_top_fields(rs.group(1)) if rs else '?'}"
            if pf and pf.group(1):
                extra += f" PartitionFilters=[{pf.group(1)[:60]}]"
        keep.append(m.group(1) + name + extra)
    return "\n".join(keep)


def main(sf_dir: str) -> None:
    spark = local_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    root = scratch_path(spark, "plans")
    feed = route_days(spark, sf_dir)
    M.build_all(spark, root, feed, ingestion_ts="2024-01-01 00:00:00")
    silver = M.read_silver(spark, root)
    gold = M.read_gold(spark, root)
    bronze = M.read_bronze(spark, root)
    plans = {
        "route-day feed": feed,
        "keep-latest dedupe (lineitem)": dedupe_latest(
            read_input(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
            ["l_shipdate", "l_partkey"]),
        "silver (flags + route rule)": silver_ops.finish_silver(
            silver_ops.add_unit_metrics(silver_ops.normalise_sentinel(bronze)), 0.0),
        "gold rollup": gold_ops.build_gold(silver, 0.0),
        "hier(bu) over stored silver": analysis.hier(silver, "bu"),
        "worst pockets (top-k)": analysis.worst_pockets(silver),
        "star slice": gold_ops.star_slice(gold, M.read_gold(spark, root, "dim_route"),
                                          M.read_gold(spark, root, "dim_date"),
                                          ["region", "quarter"]),
        "pruned gold slice": gold.where(F.col("region") == "EUROPE"),
        "z-order value": layout.zorder_value(silver, ["bu", "area", "route_id"]),
        "geo dependency check": gold_ops.geo_dependency_violations(silver),
    }
    for name, df in plans.items():
        print(f"### {name}\n```\n{tree(df)}\n```\n")
    # the plans meant for scale: no side small enough to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    for name, df in {
        "route-day feed": route_days(spark, sf_dir),
        "silver (flags + route rule)": silver_ops.finish_silver(
            silver_ops.add_unit_metrics(silver_ops.normalise_sentinel(bronze)), 0.0),
        "star slice": gold_ops.star_slice(gold, M.read_gold(spark, root, "dim_route"),
                                          M.read_gold(spark, root, "dim_date"), ["region", "quarter"]),
        "z-order value": layout.zorder_value(silver, ["bu", "area", "route_id"]),
        "drill-down": analysis.route_drilldown(silver),
    }.items():
        print(f"### {name}, broadcast off\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
