"""Run registered queries in Spark and their SQL in DuckDB and compare.

    python tests/oracle_check.py [sf_dir] [query ...]

CHECK_CONF="key=value,key=value" adds Spark settings, for instance
spark.sql.autoBroadcastJoinThreshold=-1 to check the plans of large tables.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(columns, rows):
    """Rows with columns by name, sorted; doubles as their shortest text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def _kind(name: str) -> str:
    name = name.lower()
    return {"hugeint": "bigint", "integer": "int", "varchar": "string", "bool": "boolean"}.get(name, name)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = spark_df.collect()
    cursor = con.execute(sql)
    want_cols = [d[0] for d in cursor.description]
    want_types = {d[0]: _kind(str(d[1])) for d in cursor.description}
    want = cursor.fetchall()
    if sorted(spark_df.columns) != sorted(want_cols):
        return f"columns {spark_df.columns} != {want_cols}"
    types = {n: _kind(t) for n, t in spark_df.dtypes}
    odd = {n: (types[n], want_types[n]) for n in types if types[n] != want_types[n]}
    if odd:
        return f"types {odd}"
    a, b = _rows(spark_df.columns, got), _rows(want_cols, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    import __spark_entry__ as E
    from tillworks.session import local_session

    conf = dict(c.split("=", 1) for c in os.environ.get("CHECK_CONF", "").split(",") if c)
    spark = local_session("8", **conf)
    con = connect(sf_dir)
    queries, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or queries:
        began = time.time()
        try:
            df = queries[name](spark, sf_dir)
            verdict = compare(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as e:  # report and go on
            verdict = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += verdict is not None and not verdict.startswith("rows only")
        print(f"{name:40s} {time.time() - began:6.2f}s {verdict or 'ok'}", flush=True)
    print("queries", len(queries), "sql", len(sql), "missing", sorted(set(queries) - set(sql)), "bad", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
