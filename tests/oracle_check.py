"""Compare registered queries with their SQL in DuckDB: names, types, rows."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
}


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    plain = frame.astype(object).where(frame.notna(), None)
    return sorted((tuple(str(v)[:10] if hasattr(v, "isoformat") else v for v in row)
                   for row in plain.itertuples(index=False, name=None)), key=repr)


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    actual = query(spark, sf_dir)
    expected = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in expected.description}
    actual_types = {name: _KINDS.get(kind, kind) for name, kind in actual.dtypes}
    if actual_types != expected_types:
        return f"schema: {sorted(set(actual_types.items()) ^ set(expected_types.items()))}"
    left, right = _rows(actual.toPandas()), _rows(expected.df())
    if len(left) != len(right):
        return f"rows: {len(left)} != {len(right)}"
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"first difference: {a} != {b}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry_points
    from salesmart.session import local_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    sqls = entry_points.oracle_sql()
    failed = 0
    for name, query in entry_points.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, query, sqls[name], sf_dir) if name in sqls else query(spark, sf_dir).count() and None
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        verdict = "ok  " if problem is None else "FAIL"
        print(f"{verdict} {name:32s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print("failed:", failed, "missing sql:", sorted(set(entry_points.queries()) - set(sqls)),
          "extra sql:", sorted(set(sqls) - set(entry_points.queries())))
