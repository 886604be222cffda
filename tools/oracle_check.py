"""Run registered queries in Spark and their SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from fitframe.plans.catalog import ORACLE, QUERIES  # noqa: E402
from fitframe.session import build_session  # noqa: E402
from fitframe.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, int):
        return float(v)
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def rows_of(cols, records):
    return sorted((tuple(norm(r[c]) for c in cols) for r in records), key=repr)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or list(QUERIES)
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf)
            srows = [r.asDict() for r in sdf.collect()]
            scols = sorted(sdf.columns)
            stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt = time.time() - t0
        sql = ORACLE.get(name)
        if sql is None:
            print(f"{name:28s} rows={len(srows):7d} (no oracle) {dt:6.2f}s")
            continue
        try:
            cur = con.execute(sql)
            dcols = [d[0] for d in cur.description]
            dtypes = {d[0]: str(d[1]) for d in cur.description}
            drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCKDB ERROR {e}")
            bad += 1
            continue
        ok_cols = scols == sorted(dcols)
        ok_n = len(srows) == len(drows)
        ok_v = ok_cols and rows_of(scols, srows) == rows_of(scols, drows)
        status = "OK" if ok_cols and ok_n and ok_v else "MISMATCH"
        if status != "OK":
            bad += 1
        print(f"{name:28s} {status:8s} rows={len(srows):7d}/{len(drows):7d} cols={ok_cols} vals={ok_v} {dt:6.2f}s")
        if status != "OK":
            print("   spark:", scols, stypes)
            print("   duck :", sorted(dcols), dtypes)
            if ok_cols:
                a, b = rows_of(scols, srows), rows_of(scols, drows)
                diff_a = [r for r in a if r not in set(b)][:3]
                diff_b = [r for r in b if r not in set(a)][:3]
                print("   only spark:", diff_a)
                print("   only duck :", diff_b)
        else:
            tmis = [c for c in scols if stypes[c].split("(")[0] not in _compat(dtypes[c])]
            if tmis:
                print("   type note:", {c: (stypes[c], dtypes[c]) for c in tmis})
    print("bad:", bad)


def _compat(dtype: str):
    d = dtype.upper()
    return {"BIGINT": ["bigint"], "INTEGER": ["int"], "DOUBLE": ["double"], "VARCHAR": ["string"],
            "BOOLEAN": ["boolean"], "FLOAT": ["float"], "TIMESTAMP": ["timestamp", "timestamp_ntz"],
            "DATE": ["date"]}.get(d.split("(")[0], [d.lower()])


if __name__ == "__main__":
    main()
