"""Runs queries against their oracle SQL: python tests/compare.py SF NAME..."""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = "/root/testdata"


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in sorted(Path(sf_dir).iterdir()):
        source = f"{p}/*.parquet" if p.is_dir() else p
        con.execute(f"CREATE VIEW {p.name.split('.')[0]} AS SELECT * FROM '{source}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    if isinstance(value, list):
        return [plain(v) for v in value]
    if isinstance(value, bool):
        return str(value).lower()
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(hashlib.md5(repr([plain(r[i]) for i in order]).encode()).hexdigest() for r in rows)


def differences(con, sql: str, df) -> str:
    got = df.collect()
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    want = want.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    a, b = bag(df.columns, [tuple(r) for r in got]), bag(names, want)
    if a == b:
        return ""
    order = sorted(range(len(names)), key=lambda i: names[i])
    gorder = sorted(range(len(names)), key=lambda i: df.columns[i])
    mine = sorted((repr([plain(r[i]) for i in gorder]) for r in got if 1), key=str)
    theirs = sorted((repr([plain(r[i]) for i in order]) for r in want), key=str)
    extra, lack = list((Counter(mine) - Counter(theirs)).elements()), list((Counter(theirs) - Counter(mine)).elements())
    return f"{len(got)} rows against {len(want)}; extra {len(extra)} {extra[:3]}; lacking {len(lack)} {lack[:3]}"


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as e

    from lumbung.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{DATA}/{sf}"
    con = connection(sf_dir)
    queries, oracle = e.queries(), e.oracle_sql()
    bad = 0
    for name in names or queries:
        for key in [k for k in queries if k == name or name.endswith("*") and k.startswith(name[:-1])]:
            began = time.time()
            try:
                df = queries[key](spark, sf_dir)
                said = differences(con, oracle[key], df) if key in oracle else f"rows only: {df.count()}"
                bad += bool(said) and key in oracle
            except Exception as x:  # noqa: BLE001
                said, bad = f"ERROR {str(x)[:1500]}", bad + 1
            print(f"{key}: {said or 'same'} ({time.time() - began:.1f} s)", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
