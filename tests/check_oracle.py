"""Runs every registered query beside its SQL: ``python tests/check_oracle.py [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from ledgerline.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


# Spark and DuckDB types that hold the same values.
SAME_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, name: str, sf_dir: str) -> list[str]:
    """What differs between the two results; empty when nothing does."""
    df = entry.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    theirs = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    problems = []
    if sorted(df.columns) != sorted(theirs):
        return [f"columns {sorted(df.columns)} / {sorted(theirs)}"]
    for column, kind in df.dtypes:
        if SAME_TYPE.get(kind) != theirs[column]:
            problems.append(f"type of {column}: {kind} / {theirs[column]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} / {len(want)}")
    pairs = zip(_rows(df.columns, got), _rows(list(theirs), want))
    first = next(((a, b) for a, b in pairs if a != b and not _both_nan(a, b)), None)
    if first:
        problems.append(f"values {first[0]} / {first[1]}")
    return problems


def _both_nan(a: tuple, b: tuple) -> bool:
    return all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)) for x, y in zip(a, b))


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("check", 8)
    con = connect(sf_dir)
    names = sys.argv[2:] or list(entry.oracle_sql())
    bad = 0
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, con, name, sf_dir) if name in entry.oracle_sql() else ["no SQL"]
        except Exception as error:  # report and go on
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s {'; '.join(problems)}", flush=True)
    print(f"{len(names) - bad} of {len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main())
