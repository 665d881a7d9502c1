"""Compare registered queries with their SQL in DuckDB, row by row.

    python tests/check_oracles.py [folder] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    columns = sorted(frame.columns)
    texts = frame[columns].apply(lambda c: c.map(lambda v: "" if v is None or v != v else repr(v)))
    return frame[columns].iloc[texts.sort_values(columns).index].reset_index(drop=True)


def difference(ours, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when rows, columns, types and values agree, else what differs."""
    got, want = ours.toPandas(), connection.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    got, want = normal(got), normal(want)
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    kinds = {name: kind for name, kind, *_ in described}
    spark_kinds = {f.name: f.dataType.simpleString() for f in ours.schema.fields}
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "float": "FLOAT", "boolean": "BOOLEAN"}
    for name, kind in spark_kinds.items():
        if names.get(kind, kind.upper()) != kinds[name]:
            return f"type of {name}: {kind} / {kinds[name]}"
    for name in got.columns:
        a, b = got[name], want[name]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            at = same[~same].index[0]
            return f"{name} in {int((~same).sum())} rows, first {a[at]!r} / {b[at]!r}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tradelake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "oracles", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            ours = run(spark, sf_dir)
            found = difference(ours, connection, oracles[name]) if name in oracles else f"{ours.count()} rows"
        except Exception as error:  # report every query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        print(f"{'ok  ' if not found else 'DIFF'} {name} {time.time() - began:.1f}s {found or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
