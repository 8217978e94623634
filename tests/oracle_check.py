"""Runs registered queries on Spark and their check SQL on DuckDB and compares.

    python tests/oracle_check.py [--sf /root/testdata/sf0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return "0.0" if value == 0 else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, query, oracle):
    """Empty text when both sides agree, else what differs."""
    df = query(spark, folder)
    s_cols, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if oracle is None:
        return f"rows only: {len(s_rows)}" if s_rows else "EMPTY rows-only result"
    rel = con.execute(oracle)
    d_cols, d_rows = rows_of([d[0] for d in rel.description], rel.fetchall())
    if s_cols != d_cols:
        return f"COLUMNS {s_cols} != {d_cols}"
    if s_rows != d_rows:
        s_set, d_set = set(s_rows), set(d_rows)
        only_s = [r for r in s_rows if r not in d_set][:3]
        only_d = [r for r in d_rows if r not in s_set][:3]
        return f"VALUES rows {len(s_rows)} vs {len(d_rows)}\n   cols {s_cols}\n   spark {only_s}\n   duck  {only_d}"
    return "" if s_rows else "EMPTY result"


def main() -> int:
    import __spark_entry__ as entry
    from starloom.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = local_session("8"), duck(args.sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name, query in queries.items():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        start = time.time()
        try:
            note = compare(spark, con, args.sf, name, query, oracles.get(name))
        except Exception as error:  # noqa: BLE001 - report every query
            note = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        ok = not note or note.startswith("rows only")
        if not ok:
            bad.append(name)
        print(f"{'ok  ' if ok else 'BAD '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
