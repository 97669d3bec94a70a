"""Run registered queries beside their SQL on DuckDB and compare row by row.

    python -m tests.oracle_check [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


KINDS = {
    "bigint": "int", "int": "int", "double": "float", "string": "str", "date": "date", "timestamp_ntz": "ts", "timestamp": "ts", "boolean": "bool",
    "BIGINT": "int", "INTEGER": "int", "DOUBLE": "float", "VARCHAR": "str", "DATE": "date", "TIMESTAMP": "ts", "BOOLEAN": "bool",
}


def compare(df, con, sql: str) -> tuple[bool, str]:
    got_cols = sorted(df.columns)
    got = df.select(*[f"`{c}`" for c in got_cols]).collect()
    rel = con.sql(sql)
    want_cols = sorted(rel.columns)
    if got_cols != want_cols:
        return False, f"columns {got_cols} vs {want_cols}"
    types = dict(zip(rel.columns, map(str, rel.types)))
    for f in df.schema:
        a, b = f.dataType.simpleString(), types[f.name]
        if KINDS.get(a, a) != KINDS.get(b, b):
            return False, f"type of {f.name}: {a} vs {b}"
    want = rel.project(", ".join(f'"{c}"' for c in want_cols)).fetchall()
    if len(got) != len(want):
        return False, f"rows {len(got)} vs {len(want)}"
    key = lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)
    a = sorted((tuple(cell(v) for v in row) for row in got), key=key)
    b = sorted((tuple(cell(v) for v in row) for row in want), key=key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} of {len(a)} rows differ, first {bad[0]} ({got_cols})"
    return True, f"{len(a)} rows"


def session():
    from lithosense.session import build_session

    spark = build_session("oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    p = argparse.ArgumentParser()
    p.add_argument("names", nargs="*")
    p.add_argument("--sf", default="0.01")
    args = p.parse_args()
    from lithosense.registry import ORACLES, QUERIES

    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = session(), connect(sf_dir)
    names = [n for n in QUERIES if not args.names or any(a == n or (a.endswith("*") and n.startswith(a[:-1])) for a in args.names)]
    failed = []
    for n in names:
        start = time.time()
        try:
            df = QUERIES[n](spark, sf_dir)
            if n in ORACLES:
                ok, msg = compare(df, con, ORACLES[n])
            else:
                rows = df.collect()
                ok, msg = len(rows) > 0, f"{len(rows)} rows (no SQL) {rows[0] if rows else ''}"
            if ok and msg.startswith("0 rows"):
                msg += "  <-- EMPTY"
        except Exception as e:
            ok, msg = False, f"{type(e).__name__}: {str(e)[:600]}"
        if not ok:
            failed.append(n)
        print(f"{'ok  ' if ok else 'FAIL'} {n:32s} {time.time() - start:6.2f}s {msg[:700]}", flush=True)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed: {failed}")
    spark.stop()
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
