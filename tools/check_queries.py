"""Run registered queries beside their SQL twins and compare all values.

usage: python tools/check_queries.py [--sf DIR] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lacuna.plans import catalog  # noqa: E402
from lacuna.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{plain(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows), [names[i] for i in order]


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                  "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    bad = 0
    for name, fn in catalog.QUERIES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            df = fn(spark, args.sf)
            got = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if name not in catalog.SQL:
                print(f"rows  {name:28s} {len(got):8d} {took:6.2f}s", flush=True)
                continue
            cur = con.execute(catalog.SQL[name])
            cols = [c[0] for c in cur.description]
            types = {c[0]: str(c[1]) for c in cur.description}
            left, lc = rows_of(df.columns, got)
            right, rc = rows_of(cols, cur.fetchall())
            same = lc == rc and left == right
            print(f"{'ok   ' if same else 'DIFF '} {name:28s} {len(got):8d} {took:6.2f}s  sql {time.time()-start-took:5.2f}s", flush=True)
            spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
            pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
            odd = {c: (spark_types.get(c), types.get(c)) for c in lc
                   if pairs.get(spark_types.get(c), types.get(c)) != types.get(c) and types.get(c) not in ("NUMBER", "STRING", "bool")}
            if odd:
                print("      types", odd)
            if not same:
                bad += 1
                print("      cols", lc, rc, "rows", len(left), len(right))
                diff = [(a, b) for a, b in zip(left, right) if a != b][:3]
                for a, b in diff:
                    print("      spark", a)
                    print("      sql  ", b)
        except Exception as e:  # report and go on with the next query
            bad += 1
            print(f"FAIL  {name}: {str(e)[:600]}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
