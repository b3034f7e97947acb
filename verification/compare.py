"""Run registered queries next to their SQL and report differences.

    python -m verification.compare [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from clientbook.plans import registry
from verification import duckdb_sql

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row)


def _clean(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    cleaned = [tuple(_clean(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(cleaned, key=_key)


def difference(spark: SparkSession, con, name: str, folder: str) -> str | None:
    """``None`` if both engines agree, else a short description."""
    df = registry.queries()[name](spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(duckdb_sql.oracle_sql()[name])
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])}"
    for left, right in zip(ours[1], theirs[1]):
        if left != right or [type(v) for v in left] != [type(v) for v in right]:
            return f"{dict(zip(ours[0], left))} != {dict(zip(ours[0], right))}"
    return None


def local_session(cores: str = "8") -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("clientbook")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def main(argv: list[str]) -> int:
    folder = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:] or sorted(registry.queries())
    spark, con, bad = local_session(), duck(folder), 0
    assert set(registry.queries()) == set(duckdb_sql.oracle_sql()), set(
        registry.queries()
    ) ^ set(duckdb_sql.oracle_sql())
    for name in wanted:
        start = time.time()
        try:
            found = difference(spark, con, name, folder)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
