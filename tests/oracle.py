"""Compare registered queries with their SQL in DuckDB. Usage: python tests/oracle.py FOLDER [name ...], or `checked` for all that have SQL."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from custlens.runtime import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "item"):
        return _plain(v.item())
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, folder: str, name: str, queries, oracles) -> str:
    df = queries[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    if name not in oracles:
        return f"rows only: {len(got)}"
    cur = con.execute(oracles[name])
    columns, types = [c[0] for c in cur.description], [str(c[1]) for c in cur.description]
    want = cur.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} vs {sorted(columns)}"
    a, b = _rows(df.columns, got), _rows(columns, want)
    if len(a) != len(b):
        return f"FAIL rows {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    spark_types = dict(df.dtypes)
    off = [(c, spark_types[c], t) for c, t in zip(columns, types) if kinds.get(spark_types[c]) != t]
    if bad:
        return f"FAIL {len(bad)} of {len(a)} rows, e.g.\n   {bad[0][0]}\n   {bad[0][1]}"
    return f"ok {len(a)} rows" + (f" TYPES {off}" if off else "")


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry

    spark, con = local_session(), connect(folder)
    queries, oracles, failed = entry.queries(), entry.oracle_sql(), 0
    if names == ["checked"]:
        names = list(oracles)
    for name in names or queries:
        start = time.time()
        try:
            result = compare(spark, con, folder, name, queries, oracles)
        except Exception as e:  # report and go on with the next query
            result = f"FAIL {type(e).__name__}: {str(e)[:600]}"
        failed += result.startswith("FAIL")
        print(f"{name:32s} {time.time() - start:6.1f}s  {result}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
