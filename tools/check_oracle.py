"""Run registered queries against their DuckDB SQL on one scale factor and
report row count / column names / value agreement (order-insensitive).

    python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.plans.catalog import ORACLE, QUERIES  # noqa: E402
from quarry.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return ("f", round(v, 9))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    if isinstance(v, bool):
        return ("i", int(v))
    if isinstance(v, int):
        return ("i", v)
    return ("s", str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = True
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            ok = False
            continue
        dt = time.time() - t0
        if name not in ORACLE:
            print(f"{name:28s} rows={len(srows):7d} (no oracle) {dt:6.1f}s")
            continue
        try:
            res = con.execute(ORACLE[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCKDB-ERROR {type(e).__name__}: {str(e)[:300]}")
            ok = False
            continue
        same_cols = sorted(scols) == sorted(dcols)
        same_vals = same_cols and _rows(scols, srows) == _rows(dcols, drows)
        status = "OK" if (same_cols and same_vals and len(srows) == len(drows)) else "MISMATCH"
        ok &= status == "OK"
        print(f"{name:28s} {status:8s} rows spark={len(srows)} duck={len(drows)} cols_match={same_cols} "
              f"{dt:6.1f}s")
        if status != "OK":
            if not same_cols:
                print("   spark cols", scols, "\n   duck  cols", dcols)
            else:
                a, b = _rows(scols, srows), _rows(dcols, drows)
                diff_a = [r for r in a if r not in set(b)][:3]
                diff_b = [r for r in b if r not in set(a)][:3]
                print("   only spark:", diff_a, "\n   only duck: ", diff_b)
    spark.stop()
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
