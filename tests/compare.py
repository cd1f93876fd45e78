"""Run registered queries and their SQL side by side: `python tests/compare.py sf_dir [name ...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(rows, columns, order):
    at = [columns.index(c) for c in order]
    return sorted([tuple(row[i] for i in at) for row in rows], key=repr)


# Spark type name to the DuckDB one it has to come out as.
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "double": "DOUBLE", "decimal(10,1)": "DECIMAL(10,1)",
}


def compare(df, con, sql: str) -> str | None:
    """None when rows, columns and types agree, else what differs."""
    result = con.sql(sql)
    columns = sorted(df.columns)
    if columns != sorted(result.columns):
        return f"columns {columns} / {sorted(result.columns)}"
    types = dict(zip(result.columns, map(str, result.types)))
    for column, kind in df.dtypes:
        if KINDS[kind] != types[column]:
            return f"type of {column}: {kind} / {types[column]}"
    ours = _plain(df.collect(), df.columns, columns)
    theirs = _plain(result.fetchall(), result.columns, columns)
    if ours != theirs:
        only_ours = [r for r in ours if r not in set(theirs)][:3]
        only_theirs = [r for r in theirs if r not in set(ours)][:3]
        return f"{len(ours)} / {len(theirs)} rows, {only_ours} / {only_theirs}"
    return None if ours else "no rows"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from reelhouse.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con, sql = local_session("compare"), duck(sf_dir), oracle_sql()
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(query(spark, sf_dir), con, sql[name])
        except Exception as e:  # report and go on with the others
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:34s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()
