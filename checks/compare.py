"""Compare registered queries with their SQL, as multisets of rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, name: str, sf_dir: str, connection) -> str | None:
    """None if both sides agree, else the first difference."""
    df = QUERIES[name](spark, sf_dir)
    ours = _rows(df.columns, [tuple(row) for row in df.collect()])
    relation = connection.sql(ORACLE[name])
    theirs = _rows(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} / {sorted(relation.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} / {len(theirs)} rows"
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            return f"{a} / {b}"
    if not ours:
        return "no rows on either side"
    return None


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
    return connection


def main(sf_dir: str, names: list[str]) -> int:
    from checks.session import local_session

    spark = local_session()
    connection = connect(sf_dir)
    wrong = 0
    for name in names or sorted(ORACLE):
        start = time.time()
        try:
            found = difference(spark, name, sf_dir, connection)
        except Exception as error:  # noqa: BLE001 - report and go on
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        wrong += found is not None
        print(f"{name:24s} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
    spark.stop()
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
