"""Compare registered queries with their SQL in DuckDB.

python tests/oracle.py <sf> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("documents", "conversations", "embeddings")


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(normal(r[n]) for n in names) for r in df.collect())


def duckdb_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.sql(sql)
    names = sorted(result.columns)
    at = [result.columns.index(n) for n in names]
    return names, sorted(tuple(normal(r[i]) for i in at) for r in result.fetchall())


def difference(df, sql: str, sf_dir: str) -> str | None:
    """What differs, None when nothing does."""
    names, got = spark_rows(df)
    wanted_names, wanted = duckdb_rows(sql, sf_dir)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    for a, b in zip(got, wanted):
        if a != b:
            return f"{str(a)[:300]} != {str(b)[:300]}"
    return None if got else "no rows"


def main() -> None:
    from tests.session import local_session
    from textmill.queries import ORACLES, QUERIES

    spark = local_session()
    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            found = difference(df, ORACLES[name], sf_dir) if name in ORACLES else f"no SQL, {len(df.collect())} rows"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:24} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
