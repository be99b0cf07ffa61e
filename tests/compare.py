"""Run registered queries next to their SQL and compare whole results.

    python tests/compare.py SF_DIR [NAME ...]
"""

from __future__ import annotations

import datetime as dt
import glob
import hashlib
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def database(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return repr(v)


def digest(columns, rows):
    """Order-free digest of a result, columns taken in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_value(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\x1e".join(lines).encode()).hexdigest()


def compare(spark, con, sf_dir, name, run, sql):
    """None when equal, otherwise what differs."""
    df = run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None
    found = con.sql(sql)
    want = found.fetchall()
    if sorted(df.columns) != sorted(found.columns):
        return f"columns {df.columns} / {found.columns}"
    kinds = dict(zip(found.columns, [str(x) for x in found.types]))
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
             "smallint": "SMALLINT", "tinyint": "TINYINT", "binary": "BLOB"}
    kind_diff = {
        f.name: (f.dataType.simpleString(), kinds[f.name])
        for f in df.schema
        if names.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) != kinds[f.name]
    }
    if len(rows) != len(want):
        return f"{len(rows)} rows / {len(want)}"
    if digest(df.columns, rows) != digest(found.columns, want):
        order = [found.columns.index(c) for c in df.columns]
        mine = {tuple(map(_value, r)) for r in rows}
        theirs = {tuple(_value(r[i]) for i in order) for r in want}
        return f"values, e.g. {sorted(mine - theirs)[:2]} / {sorted(theirs - mine)[:2]} types {kind_diff}"
    if kind_diff:
        return f"types {kind_diff}"
    return None


def main(sf_dir, only):
    from tests.conftest import make_session

    import __spark_entry__ as entry

    spark, con = make_session(), database(sf_dir)
    sql, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, run, sql.get(name))
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
