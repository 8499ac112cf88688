"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Comparison: same row count, same column names, and the same multiset of rows
after sorting columns by name (floats compared after rounding to 9 significant
digits; NaN equals NaN).  Usable from pytest and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        if math.isinf(v):
            return ("inf", v > 0)
        return ("f", float(f"{v:.9g}"))
    if hasattr(v, "isoformat"):
        return ("d", v.isoformat()[:10])
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("f", float(v))
    try:
        from decimal import Decimal

        if isinstance(v, Decimal):
            return ("f", float(f"{float(v):.9g}"))
    except ImportError:
        pass
    return ("s", str(v))


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
              "BOOLEAN": "boolean"}


def compare(spark, sf_dir: str, name: str, fn, sql: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    o_types = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    o_cols = list(rel.columns)
    o_rows = rel.fetchall()
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    if s_types != o_types:
        return False, f"types differ: {[(c, s_types[c], o_types[c]) for c in s_cols if s_types[c] != o_types[c]]}"
    if len(s_rows) != len(o_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(o_rows)}"
    a, b = canon(s_cols, s_rows), canon(o_cols, o_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s_rows)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    import __spark_entry__ as entry
    from tessera.session import local_session

    spark = local_session()
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in sorted(qs):
        if wanted and name not in wanted:
            continue
        t = time.time()
        if name not in sqls:
            try:
                n = qs[name](spark, sf_dir).count()
                print(f"ROWS  {name:32s} {n} rows  {time.time() - t:.1f}s", flush=True)
            except Exception as exc:  # noqa: BLE001
                bad += 1
                print(f"ERROR {name:32s} {type(exc).__name__}: {str(exc)[:300]}", flush=True)
            continue
        try:
            ok, msg = compare(spark, sf_dir, name, qs[name], sqls[name], con)
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"{type(exc).__name__}: {str(exc)[:400]}"
        bad += 0 if ok else 1
        print(f"{'OK   ' if ok else 'FAIL '} {name:32s} {msg}  {time.time() - t:.1f}s", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
