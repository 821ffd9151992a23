"""Compare registered queries with their SQL twins, rows as sorted multisets."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, db, sql: str) -> list[str]:
    """What differs; an empty list when columns and rows agree exactly."""
    got = df.collect()
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    found = []
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    if len(got) != len(expected):
        found.append(f"{len(got)} rows != {len(expected)}")
    ours, theirs = _rows(df.columns, got), _rows(columns, expected)
    if ours != theirs:
        missing, extra = set(theirs) - set(ours), set(ours) - set(theirs)
        found.append(f"missing {len(missing)}: {sorted(missing)[:3]}")
        found.append(f"extra {len(extra)}: {sorted(extra)[:3]}")
    return found


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            found = differences(df, db, entry.oracle_sql()[name])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'DIFF' if found else 'ok':4} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("     " + line)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
