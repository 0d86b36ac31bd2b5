"""Runs registered queries next to their SQL and reports differences.

    python tests/compare.py [folder] [query ...]
"""

import math
import sys
import time
from datetime import datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{v:.12g}"
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _rows(table):
    columns = sorted(table.column_names)
    data = table.select(columns).to_pydict()
    return columns, sorted(tuple(map(_value, row)) for row in zip(*data.values()))


def kinds(table):
    """Column types, as far as both engines name them alike."""
    out = {}
    for field in table.schema:
        name = str(field.type)
        for long, short in (("timestamp", "timestamp"), ("large_string", "string")):
            name = short if name.startswith(long) else name
        out[field.name] = name
    return out


def difference(spark, db, name, build, sql, folder):
    """None if both give the same columns, types and rows, else what differs."""
    ours, theirs = build(spark, folder).toArrow(), db.execute(sql).to_arrow_table()
    if kinds(ours) != kinds(theirs):
        return f"types {set(kinds(ours).items()) ^ set(kinds(theirs).items())}"
    (columns, a), (_, b) = _rows(ours), _rows(theirs)
    if a != b:
        extra, lacking = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return f"{len(a)} rows against {len(b)}; {columns}\n  only ours {extra[:3]}\n  only SQL  {lacking[:3]}"
    return None if a else "EMPTY"


def main(folder="/root/testdata/sf0.01", *names):
    import __spark_entry__ as entry
    from ratecal.session import local_session

    spark, db = local_session(8), connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        if name not in sqls:
            print(f"{name:24} no SQL")
            continue
        try:
            found = difference(spark, db, name, queries[name], sqls[name], folder)
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24} {time.time() - start:6.1f} s  {found or 'ok'}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
