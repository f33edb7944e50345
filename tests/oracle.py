"""Run a registered query and its SQL side by side.

    python tests/oracle.py <folder> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _sorted_rows(rows, order):
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and the result of the SQL; empty if nothing does."""
    result = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in result.description}
    sql_rows = result.fetchall()
    problems = []
    if sorted(df.columns) != sorted(sql_types):
        return [f"columns {sorted(df.columns)} != {sorted(sql_types)}"]
    for name, dtype in df.dtypes:
        if TYPES.get(dtype, dtype.upper()) != sql_types[name]:
            problems.append(f"type of {name}: {dtype} != {sql_types[name]}")
    names = sorted(df.columns)
    rows = df.collect()
    left = _sorted_rows(rows, [df.columns.index(n) for n in names])
    right = _sorted_rows(sql_rows, [list(sql_types).index(n) for n in names])
    if not left:
        problems.append("no rows")
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} of {len(left)} rows differ, {names}: {wrong[0][0]} != {wrong[0][1]}")
    return problems


def main() -> int:
    from shelfcurve.catalog import ORACLES, QUERIES
    from shelfcurve.session import local_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session("8"), connect(sf_dir), 0
    for name in chosen:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problems = differences(df, con, ORACLES[name]) if name in ORACLES else [f"rows only: {df.count()}"]
        except Exception as error:  # noqa: BLE001 - report and go on
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if not problems else problems}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
