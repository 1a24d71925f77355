"""Compare registered queries with their SQL.

python tests/check_oracles.py [--no-broadcast] [sf_dir] [query ...]

``--no-broadcast`` turns off size-based broadcasts, as if every table were large.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
}


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    df = entry.queries()[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    types = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cur.description}
    want = _rows(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if types != dict(df.dtypes):
        return f"types { {k: (t, types[k]) for k, t in df.dtypes if types[k] != t} }"
    if not want:
        return "no rows"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(want)} rows differ, first {sorted(df.columns)}: {bad[0]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    args = [a for a in sys.argv[1:] if a != "--no-broadcast"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    threshold = "-1" if len(args) < len(sys.argv) - 1 else "10MB"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.autoBroadcastJoinThreshold", threshold)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    db = connect(sf)
    failed = 0
    for key in args[1:] or entry.oracle_sql():
        start = time.time()
        try:
            what = difference(session, db, key, sf)
        except Exception as e:  # noqa: BLE001
            what = f"{type(e).__name__}: {str(e)[:400]}"
        failed += what is not None
        print(f"{'ok  ' if what is None else 'FAIL'} {key} {time.time() - start:.1f}s {what or ''}")
    print(f"{failed} failed")
    sys.exit(bool(failed))
