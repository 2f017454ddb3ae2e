"""Run plans next to their comparison SQL: ``python tests/oracle.py [name-prefix ...] [--blocks=N] [--sf=0.01]``."""

from __future__ import annotations

import datetime
import math
import pathlib
import sys
import time
import traceback

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import duckdb  # noqa: E402

from attesta.tables import NAMES  # noqa: E402

DATA = "/root/testdata"


def connect(sf: str):
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/sf{sf}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)
    return [columns[i] for i in order], body


def compare(df, con, sql):
    got = table(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want = table([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(got[1])
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}; {got[1][:2]} {want[1][:2]}", len(got[1])
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    return (f"{len(bad)} rows differ, first {bad[0]}" if bad else None), len(got[1])


def main(argv):
    opts = dict(a[2:].split("=") for a in argv if a.startswith("--"))
    wanted = [a for a in argv if not a.startswith("--")]
    sf = opts.get("sf", "0.01")
    from attesta.session import local_session
    from attesta.plans import oracle_sql, queries

    extra = {"attesta.rows.per.block": opts["blocks"]} if "blocks" in opts else {}
    spark, con, sql, failed = local_session(**extra), connect(sf), oracle_sql(), 0
    for name, fn in queries().items():
        if wanted and not any(name == w or name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            df = fn(spark, f"{DATA}/sf{sf}")
            if name in sql:
                problem, n = compare(df, con, sql[name])
            else:
                problem, n = None, len(df.collect())
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
            if "trace" in opts:
                traceback.print_exc()
        failed += problem is not None
        note = "" if name in sql else " rows-only"
        empty = " EMPTY" if n == 0 else ""
        print(f"{'FAIL' if problem else 'ok  '} {name} n={n} {time.time() - began:.1f}s{note}{empty} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
