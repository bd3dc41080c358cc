"""Local stand-in for the driver's correctness gate.

Runs every ``queries()`` entry in Spark and its ``oracle_sql()`` text in DuckDB
on the same parquet tables, then compares row count, column names and an
order-insensitive hash of the values. Usage:

    python tests/oracle_check.py [--plain] [sf_dir] [name ...]

``--plain`` uses a session built without this package's defaults, as the
driver builds its own.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def duck_rows(sf_dir, sql):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return cols, [tuple(r) for r in res.fetchall()]


def main():
    args = [a for a in sys.argv[1:] if a != "--plain"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    only = set(args[1:])
    import __spark_entry__ as E
    if "--plain" in sys.argv:
        # a session as the driver builds it, without this package's defaults
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        from taxograde.session import get_session
        spark = get_session("local[8]", shuffle_partitions=8)
    qs, oracles = E.queries(), E.oracle_sql()
    failed = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            failed += 1
            continue
        st = time.time() - t
        if name not in oracles:
            print(f"ROWS {name}: {len(srows)} rows ({st:.1f}s, no oracle)")
            continue
        try:
            dcols, drows = duck_rows(sf_dir, oracles[name])
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            failed += 1
            continue
        sh, sl = digest(srows, scols)
        dh, dl = digest(drows, dcols)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and sh == dh
        if ok:
            print(f"OK   {name}: {len(srows)} rows ({st:.1f}s)")
        else:
            failed += 1
            print(f"FAIL {name}: spark {len(srows)} rows {sorted(scols)}; duck {len(drows)} rows {sorted(dcols)}")
            sd, dd = set(sl), set(dl)
            for x in sorted(sd - dd)[:3]:
                print("   spark only:", x[:300])
            for x in sorted(dd - sd)[:3]:
                print("   duck only: ", x[:300])
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
