"""Runs registered queries beside their SQL in DuckDB: ``python tests/oracle_check.py [sf] [keys]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalog.oracle import ORACLE  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def compare(spark, con, key: str, sf_dir: str) -> str | None:
    """None if equal: same columns, same value types, same rows as a multiset."""
    df = QUERIES[key](spark, sf_dir)
    got_columns = sorted(df.columns)
    got = [tuple(_plain(r[c]) for c in got_columns) for r in df.collect()]
    if key not in ORACLE:
        return None if got else "no rows"
    cursor = con.execute(ORACLE[key])
    names = [d[0] for d in cursor.description]
    order = [names.index(c) for c in sorted(names)]
    want = [tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()]
    if got_columns != sorted(names):
        return f"columns {got_columns} != {sorted(names)}"
    kinds = [
        {c: {type(r[i]) for r in rows} - {type(None)} for i, c in enumerate(got_columns)} for rows in (got, want)
    ]
    if kinds[0] != kinds[1]:
        return f"types {[(c, kinds[0][c], kinds[1][c]) for c in got_columns if kinds[0][c] != kinds[1][c]]}"
    extra, lacking = Counter(got) - Counter(want), Counter(want) - Counter(got)
    if extra or lacking:
        return f"{len(got)} vs {len(want)} rows; only here {list(extra)[:2]}; only SQL {list(lacking)[:2]}"
    return None


def main() -> None:
    from loanweave.session import get_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    keys = sys.argv[2:] or list(QUERIES)
    spark = get_session("oracle", spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for key in keys:
        start = time.perf_counter()
        try:
            problem = compare(spark, con, key, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {key} {time.perf_counter() - start:.2f}s {problem or ''}", flush=True)
    print("failed:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
