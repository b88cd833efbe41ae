"""Run catalog queries on Spark and their SQL twins on DuckDB; report
row-count, column and value agreement (exact for all types)."""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from haulwise.plans.catalog import catalog  # noqa: E402
from haulwise.plans.sql_twins import twins  # noqa: E402
from haulwise.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def main(sf_dir, names=None):
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = catalog(), twins()
    ok = 0
    for name in names or qs:
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name}: SPARK ERROR {str(e)[:400]}")
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"{name}: spark rows={len(s_rows)} (no twin) {t1-t0:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name}: DUCKDB ERROR {str(e)[:400]}")
            continue
        same_cols = sorted(s_cols) == sorted(d_cols)
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        same = same_cols and a == b
        ok += same
        msg = f"{name}: rows spark={len(s_rows)} duck={len(d_rows)} cols={'ok' if same_cols else (s_cols, d_cols)} values={'MATCH' if same else 'DIFF'} {t1-t0:.1f}s"
        print(msg, flush=True)
        if not same and same_cols:
            sa, sb = set(a), set(b)
            for x in list(sa - sb)[:2]:
                print("   spark only:", x)
            for x in list(sb - sa)[:2]:
                print("   duck  only:", x)
    print(f"{ok} matched")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:] or None)
