"""Run queries and their SQL side by side: python -m tests.oracle [--sf 0.01] [names...]."""

from __future__ import annotations

import argparse
import datetime
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return ("float", repr(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return ("time", str(value))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return (type(value).__name__, value)


def compare(df, connection, sql: str) -> str:
    """Empty text if both results agree, else a description of the difference."""
    names = sorted(df.columns)
    ours = Counter(tuple(_plain(row[n]) for n in names) for row in df.collect())
    cursor = connection.execute(sql)
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != names:
        return f"columns {names} against {sorted(columns)}"
    places = [columns.index(n) for n in names]
    theirs = Counter(tuple(_plain(row[i]) for i in places) for row in cursor.fetchall())
    if ours == theirs:
        return "" if ours else "both results are empty"
    missing, extra = theirs - ours, ours - theirs
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; {sum(extra.values())} differ\n"
        f"    only here: {list(extra)[:2]}\n    only SQL:  {list(missing)[:2]}"
    )


def main() -> None:
    import __spark_entry__ as entry
    from sparksignal.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        "oracle",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = []
    for name in args.names or queries:
        began = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sql:
                problem = compare(df, connection, sql[name])
            else:
                problem = "" if df.count() else "empty"
        except Exception as error:  # keep going and list every failure
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql" if name in sql else "rows"
        print(f"{'ok  ' if not problem else 'FAIL'} {time.time() - began:6.1f}s {kind:4} {name} {problem}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")


if __name__ == "__main__":
    main()
