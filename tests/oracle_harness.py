"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Comparison: column names, row count, and the sorted multiset of rows rendered
as text (floats rounded to 6 places).
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _cell(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "item"):
        return _cell(v.item())
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


_TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "float": "FLOAT"}


def rows_of(records) -> list[tuple]:
    return sorted(tuple(_cell(x) for x in r) for r in records)


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, name: str, build, sql: str | None, con) -> dict:
    t0 = time.time()
    sdf = build(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    dcols = list(rel.columns)
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    bad_types = {c: (stypes[c], dtypes.get(c)) for c in stypes
                 if _TYPE_MAP.get(stypes[c], stypes[c]) != dtypes.get(c)}
    if bad_types:
        res["types"] = bad_types
    drows = rel.fetchall()
    res["duck_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS {scols} vs {dcols}"
        return res
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    a, b = rows_of(srows), rows_of(drows)
    if a == b:
        res["status"] = "ok"
    else:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["status"] = "MISMATCH"
        res["spark_only"] = diff_a
        res["duck_only"] = diff_b
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from tokloom.session import build_session, ensure_checkpoint_dir
    import __spark_entry__ as E
    spark = build_session("local[8]", 8)
    ensure_checkpoint_dir(spark)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connect(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls.get(name), con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names or qs) - bad} passed, {bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
