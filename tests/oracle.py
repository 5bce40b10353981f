"""Runs registered queries next to their SQL twins and compares whole results.

    python -m tests.oracle [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Spark type: the DuckDB type that a twin must return.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def duck_type(kind: str) -> str:
    if kind.startswith("array<"):
        return duck_type(kind[6:-1]) + "[]"
    return SAME_TYPE.get(kind, kind)


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0  # one zero
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def differences(frame, con, sql: str) -> list[str]:
    """Human-readable differences between a DataFrame and a twin; empty when equal."""
    relation = con.sql(sql)
    columns, types = relation.columns, [str(t) for t in relation.types]
    found = []
    if sorted(frame.columns) != sorted(columns):
        return [f"columns {sorted(frame.columns)} != {sorted(columns)}"]
    theirs = dict(zip(columns, types))
    for field in frame.schema:
        want = duck_type(field.dataType.simpleString())
        if want != theirs[field.name]:
            found.append(f"type of {field.name}: {want} != {theirs[field.name]}")
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    right = Counter(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    left = Counter(tuple(plain(v) for v in r) for r in frame.select(*[f"`{c}`" for c in order]).collect())
    if left != right:
        only_l, only_r = list((left - right).elements()), list((right - left).elements())
        found.append(f"rows {sum(left.values())} and {sum(right.values())}; {len(only_l)} / {len(only_r)} differ")
        key = lambda r: tuple(map(str, r))
        found += [f"  spark {str(r)[:300]}" for r in sorted(only_l, key=key)[:3]]
        found += [f"  sql   {str(r)[:300]}" for r in sorted(only_r, key=key)[:3]]
    return found


def main() -> int:
    from quillframe.queries import REGISTRY, Tables
    from quillframe.session import local_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con = local_session(8), duck(folder)
    spark.sparkContext.setLogLevel("OFF")
    bad = 0
    for name, q in REGISTRY.items():
        if args and not any(a in name for a in args):
            continue
        began = time.time()
        try:
            frame = q.run(Tables(spark, folder))
            result = differences(frame, con, q.sql) if q.sql else [] if frame.count() else ["no rows"]
        except Exception as error:  # report and go on with the other queries
            result = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(result)
        print(f"{'FAIL' if result else 'ok  '} {name} {time.time() - began:.2f}s{'' if q.sql else ' (no twin)'}", flush=True)
        for line in result:
            print("     " + line, flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
