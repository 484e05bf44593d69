"""Runs registered queries beside their SQL and compares rows.

Usage: ``python -m checks.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path


def _value(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def spark_rows(frame) -> tuple[list[str], Counter]:
    names = sorted(frame.columns)
    rows = frame.select(*[f"`{n}`" for n in names]).collect()
    return names, Counter(tuple(_value(v) for v in row) for row in rows)


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = cursor.fetchall()
    return [names[i] for i in order], Counter(
        tuple(_value(row[i]) for i in order) for row in rows)


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def difference(frame, connection, sql: str) -> str | None:
    """Why the two disagree, or None."""
    names, rows = spark_rows(frame)
    sql_names, expected = sql_rows(connection, sql)
    if names != sql_names:
        return f"columns {names} and {sql_names}"
    if rows != expected:
        return (f"{rows.total()} rows and {expected.total()}; only Spark "
                f"{list((rows - expected))[:3]}; only SQL {list((expected - rows))[:3]}")
    return None


def main() -> int:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    from checks.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark, connection = local_session(), connect(sf_dir)
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            frame = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                outcome = difference(frame, connection, ORACLES[name])
            else:
                outcome = None if frame.count() >= 0 else "no rows"
        except Exception as error:
            outcome = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += outcome is not None
        print(f"{'ok  ' if outcome is None else 'FAIL'} {time.time() - start:6.2f}s {name} "
              f"{outcome or ''}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
