"""Run registered queries against their SQL: python tools/compare.py [sf] [name part ...]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from tessera.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def _close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 2e-9 * max(abs(a), abs(b))
    return a == b


def compare(spark, con, query, folder: str) -> str:
    """Return 'ok', 'rows N' for queries without SQL, or a description of the difference."""
    start = time.time()
    df = query(spark, folder)
    got = [tuple(_plain(v) for v in r) for r in df.collect()]
    print(f"{time.time() - start:6.2f}s ", end="")
    if query.sql is None:
        return f"rows {len(got)}"
    cur = con.execute(query.oracle())
    names = [d[0] for d in cur.description]
    if names != df.columns:
        return f"DIFF columns {df.columns} vs {names}"
    want = [tuple(_plain(v) for v in r) for r in cur.fetchall()]
    if len(got) != len(want):
        return f"DIFF rows {len(got)} vs {len(want)}; {sorted(map(str, got))[:2]} vs {sorted(map(str, want))[:2]}"
    # exact columns first, so that a last digit does not pair different rows
    exact_first = lambda r: sorted(r, key=lambda v: isinstance(v, float))
    key = lambda r: tuple((v is None, str(type(v)), float(f"{v:.5e}") if isinstance(v, float) else v) for v in exact_first(r))
    bad = [(g, w) for g, w in zip(sorted(got, key=key), sorted(want, key=key)) if not all(map(_close, g, w))]
    if bad:
        return f"DIFF {len(bad)} of {len(got)} rows, e.g. {bad[0][0]} vs {bad[0][1]}"
    exact = "" if sorted(map(str, got)) == sorted(map(str, want)) else " (last digit differs)"
    return f"ok {len(got)}{exact}"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    from tessera.catalog import QUERIES

    folder = f"/root/testdata/sf{sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failures = 0
    for name, q in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            result = compare(spark, con, q, folder)
        except Exception as e:  # a broken query must not hide the others
            result = "ERROR " + str(e).strip()[:600]
        failures += result.startswith(("DIFF", "ERROR"))
        print(f"({time.time() - start:6.2f}s) {name}: {result}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
