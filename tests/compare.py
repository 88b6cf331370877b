"""Compare registered queries with their SQL counterparts in DuckDB."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else f"{value:.6f}"
    return "NULL" if value is None else str(value)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def mismatch(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """A short description of the first difference, or None when there is none."""
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    expected_rows = result.fetchall()
    names = [d[0] for d in result.description]
    got = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema}
    if sorted(got) != sorted(names):
        return f"columns {sorted(got)} != {sorted(names)}"
    wrong = {n: (got[n], types[n]) for n in got if got[n] != types[n]}
    if wrong:
        return f"types {wrong}"
    actual = canonical(spark_df.columns, spark_df.collect())
    expected = canonical(names, expected_rows)
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    for a, b in zip(actual, expected):
        if a != b:
            return f"first difference {a} != {b}"
    return None


def main(sf_dir: str, keys: list[str]) -> int:
    import __spark_entry__ as entry

    from curbline.session import local_session

    import faulthandler

    faulthandler.dump_traceback_later(int(os.environ.get("CHECK_SECONDS", "600")), exit=True)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = duck(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for key in keys or queries:
        start = time.time()
        try:
            if key in oracles:
                problem = mismatch(queries[key](spark, sf_dir), con, oracles[key])
            else:
                rows = queries[key](spark, sf_dir).count()
                problem = None if rows else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {key} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
