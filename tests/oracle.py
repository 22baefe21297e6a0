"""Compare a Spark result with its DuckDB text: ``python -m tests.oracle [sf] [names...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from quarrymill.tables import TABLE_NAMES


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _kind(value) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, (float, decimal.Decimal)):
        return type(value).__name__.lower()
    if isinstance(value, dt.datetime):
        return "timestamp"
    return type(value).__name__


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def canonical(columns, rows):
    """Columns sorted by name, rows sorted by text, and the kinds seen per column."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    kinds = [set() for _ in order]
    out = []
    for row in rows:
        picked = [row[i] for i in order]
        for k, v in zip(kinds, picked):
            if v is not None:
                k.add(_kind(v))
        out.append(tuple(_plain(v) for v in picked))
    out.sort(key=repr)
    return names, kinds, out


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short text on the first difference."""
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = canonical([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if len(got[2]) != len(want[2]):
        return f"rows {len(got[2])} against {len(want[2])}; {got[2][:2]} / {want[2][:2]}"
    for name, a, b in zip(got[0], got[1], want[1]):
        if a != b:
            return f"column {name}: {a} against {b}"
    for a, b in zip(got[2], want[2]):
        if a != b:
            return f"{a} against {b}"
    if not got[2]:
        return "empty result"
    return None


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from quarrymill.session import local_session

    sf = argv[0] if argv else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    con = connect(folder)
    sqls = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if argv[1:] and not any(name == a or (a.endswith("*") and name.startswith(a[:-1])) for a in argv[1:]):
            continue
        t0 = time.time()
        try:
            if name in sqls:
                note = difference(fn(spark, folder), con, sqls[name])
            else:
                rows = fn(spark, folder).collect()
                note = None if rows else "empty result"
        except Exception as e:  # report and go on with the next query
            note = f"{type(e).__name__}: {str(e)[:600]}"
        bad += note is not None
        print(f"{'ok ' if note is None else 'BAD'} {name} {time.time() - t0:.2f}s"
              + ("" if name in sqls else " (rows only)") + (f"\n    {note}" if note else ""), flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
