"""Run a query and its SQL twin and compare names, types and values.

As a script: ``python -m tests.twin_check [--dir DIR] [names...]``.
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def differences(df, con, sql: str) -> list[str]:
    """Empty if the DataFrame and the SQL agree."""
    cur = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cur.description}
    columns = sorted(types)
    if sorted(df.columns) != columns:
        return [f"columns {sorted(set(df.columns) ^ set(columns))}"]
    found = []
    for c in columns:
        spark_type = df.schema[c].dataType.simpleString()
        if TYPES.get(spark_type, spark_type) != types[c]:
            found.append(f"type of {c}: {spark_type} / {types[c]}")
    order = [d[0] for d in cur.description]
    positions = [order.index(c) for c in columns]
    expected = Counter(tuple(_normal(row[i]) for i in positions) for row in cur.fetchall())
    actual = Counter(tuple(_normal(row[c]) for c in columns) for row in df.collect())
    if expected != actual:
        extra, missing = actual - expected, expected - actual
        found.append(
            f"rows {sum(actual.values())} / {sum(expected.values())}, only here {sum(extra.values())}, "
            f"only there {sum(missing.values())}"
        )
        for label, rows in (("here", extra), ("there", missing)):
            for row in sorted(rows, key=repr)[:3]:
                found.append(f"  {label}: " + ", ".join(f"{c}={v!r}" for c, v in zip(columns, row))[:700])
    return found


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = argparse.ArgumentParser()
    args.add_argument("--dir", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, twins, con, bad = entry.queries(), entry.oracle_sql(), connect(opts.dir), 0
    for name in opts.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, opts.dir)
            found = differences(df, con, twins[name]) if name in twins else [] if df.collect() else ['no rows']
        except Exception as e:  # report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok'} {name} {time.time() - start:.1f}s {'' if name in twins else '(rows only)'}", flush=True)
        for line in found:
            print("    " + line, flush=True)
    print(f"{bad} differ", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
