"""Compare registered queries with their SQL on the same files.

Usage: python tests/oracle.py [sf folder] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KIND = {
    "integer": "int", "bigint": "bigint", "double": "double", "varchar": "string", "boolean": "boolean",
    "timestamp": "timestamp", "float": "float",
}


def duck(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, folder: str) -> str:
    """Empty when rows, columns and types agree, otherwise what differs."""
    from scorepipe.queries import ORACLES, QUERIES

    frame = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in frame.collect()]
    if name not in ORACLES:
        return "" if rows else "no rows"
    result = con.execute(ORACLES[name])
    types = {c[0]: KIND.get(str(c[1]).lower(), str(c[1]).lower()) for c in result.description}
    wanted = result.fetchall()
    kinds = {f.name: f.dataType.simpleString().replace("timestamp_ntz", "timestamp") for f in frame.schema.fields}
    if kinds != types:
        return f"schema: {sorted(set(kinds.items()) ^ set(types.items()))}"
    a, b = canonical(rows, list(frame.columns)), canonical(wanted, list(types))
    if a == b:
        return ""
    ours, theirs = set(a) - set(b), set(b) - set(a)
    return f"{len(a)} rows, wanted {len(b)}; only ours {sorted(ours)[:3]}; only SQL {sorted(theirs)[:3]}"


def main() -> int:
    from scorepipe.queries import ORACLES, QUERIES
    from scorepipe.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session(), duck(folder), 0
    for name in names:
        start = time.time()
        try:
            found = compare(spark, con, name, folder)
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(found)
        mark = "ok " if not found else "BAD"
        print(f"{mark} {name} {time.time() - start:.1f}s{'' if name in ORACLES else ' (rows only)'} {found}", flush=True)
        spark.catalog.clearCache()
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
