"""Run registered queries beside their SQL and compare the rows.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind in "iuf":
            df[c] = df[c].astype(float)
        else:
            df[c] = df[c].map(lambda v: None if v is None or v != v else v)
    return df.sort_values(list(df.columns), key=lambda s: s.map(repr)).reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    a, b = canonical(ours), canonical(theirs)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = (~same).idxmax()
            return f"column {c}: {(~same).sum()} rows differ, first {a[c][i]!r:.150} != {b[c][i]!r:.150}"
    return None


def kinds(spark_df, con, sql: str) -> str | None:
    """Spark and DuckDB types that a strict comparison would tell apart."""
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "float": "FLOAT"}
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = [(n, t, theirs.get(n)) for n, t in spark_df.dtypes if names.get(t) != theirs.get(n)]
    return str(wrong) if wrong else None


def main() -> int:
    from quern.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("OFF")
    con, failed = connect(sf_dir), 0
    for name in wanted:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            ours = df.toPandas()
            took = time.time() - start
            sql = entry.oracle_sql().get(name)
            problem = difference(ours, con.execute(sql).df()) if sql else None
            note = kinds(df, con, sql) if sql else "no SQL"
        except Exception as e:  # noqa: BLE001
            problem, note, took, ours = f"{type(e).__name__}: {str(e)[:1500]}", None, time.time() - start, ()
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name:28} {len(ours):8} rows {took:6.2f}s {problem or ''} {note or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
