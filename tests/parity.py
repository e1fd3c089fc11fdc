"""Compare registered queries with their check SQL run by DuckDB.

Stricter than a hash of rounded values: same columns, same Python types, equal
values bit for bit, regardless of row order.

    python tests/parity.py [sf_dir] [key ...]

PARITY_ZONE sets the session's time zone, PARITY_BROADCAST the broadcast
threshold (-1: sort-merge joins only): neither may change a result.
"""

from __future__ import annotations

import collections
import datetime
import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, datetime.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", tuple(normal(v) for v in value))
    if value is None or isinstance(value, (str, bytes)):
        return value
    return (type(value).__name__, value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        collections.Counter(tuple(normal(row[i]) for i in order) for row in rows),
    )


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, sf_dir, run, sql):
    """None if equal, else a short description of the difference; and the row count."""
    df = run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    columns, got = canonical(df.columns, rows)
    if sql is None:
        return None, len(rows)
    result = con.execute(sql)
    wanted_columns, want = canonical([d[0] for d in result.description], result.fetchall())
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}", len(rows)
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"rows {sum(got.values())} vs {sum(want.values())}; extra {extra} missing {missing}", len(rows)
    return None, len(rows)


def main() -> int:
    from visitry.catalog import ORACLES, QUERIES
    from visitry.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                       "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
                       "spark.sql.session.timeZone": os.environ.get("PARITY_ZONE", "UTC"),
                       "spark.sql.autoBroadcastJoinThreshold": os.environ.get("PARITY_BROADCAST", "10MB"),
                       "spark.sql.adaptive.autoBroadcastJoinThreshold": os.environ.get("PARITY_BROADCAST", "10MB")}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for key in keys:
        start = time.time()
        try:
            problem, n = compare(spark, con, sf_dir, QUERIES[key], ORACLES.get(key))
        except Exception as error:  # report and go on with the next key
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += problem is not None
        kind = "sql" if key in ORACLES else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {key} [{kind}] {n} rows {time.time() - start:.2f}s"
              + (f"\n    {problem}" if problem else ""), flush=True)
    print(f"{len(keys)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
