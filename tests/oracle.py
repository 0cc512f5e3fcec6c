"""Compare catalogue queries with their SQL on the test tables: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if hasattr(value, "as_tuple"):
        return repr(float(value))
    return repr(value)


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, folder: str) -> tuple[bool, str]:
    df = entry.queries()[name](spark, folder)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return bool(got), f"rows only: {len(got)}"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = canonical(cursor.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return True, f"{len(got)} rows"
    extra, missing = [r for r in got if r not in set(want)][:2], [r for r in want if r not in set(got)][:2]
    return False, f"{len(got)} vs {len(want)} rows\n   spark {extra}\n   sql   {missing}"


if __name__ == "__main__":
    from tests.conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    session, folder = make_session(), f"/root/testdata/sf{sf}"
    con, bad = connect(folder), []
    for name in chosen:
        start = time.time()
        try:
            ok, note = compare(session, con, name, folder)
        except Exception as e:
            ok, note = False, "".join(traceback.format_exception_only(e))[:1500]
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note[:1500]}", flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)
