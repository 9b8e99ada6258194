"""Run registered queries beside their SQL and compare: columns, row count, values.

    python -m tests.oracle_check [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

import __spark_entry__ as entry_points
from rowsmith.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def compare(spark, con, sf: str, name: str, query, sql: str | None) -> tuple[bool, str]:
    started = time.time()
    df = query(spark, sf)
    columns = sorted(df.columns)
    mine = sorted((tuple(plain(v) for v in row) for row in df.select(*columns).collect()), key=repr)
    spent = time.time() - started
    if sql is None:
        return bool(mine), f"rows only, {len(mine)} rows, {spent:.1f}s"
    ran = con.execute(sql)
    names = [d[0] for d in ran.description]
    if sorted(names) != columns:
        return False, f"columns {columns} against {sorted(names)}"
    at = [names.index(c) for c in columns]
    theirs = sorted((tuple(plain(row[i]) for i in at) for row in ran.fetchall()), key=repr)
    if mine == theirs:
        return bool(mine), f"{len(mine)} rows, {spent:.1f}s" + ("" if mine else " (empty)")
    off = [(a, b) for a, b in zip(mine, theirs) if a != b][:2]
    return False, f"{len(mine)} rows against {len(theirs)}; first differences {str(off)[:900]}"


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), []
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    for name, query in queries.items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        try:
            good, note = compare(spark, con, sf, name, query, oracles.get(name))
        except Exception as error:
            good, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        print("ok  " if good else "BAD ", name, note, flush=True)
        if not good:
            bad.append(name)
    print(f"{len(bad)} bad:", *bad)
    return len(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
