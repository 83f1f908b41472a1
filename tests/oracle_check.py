"""Run registered queries beside their oracle SQL and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )


def compare(spark, con, sf_dir: str, run, sql: str | None) -> tuple[bool, str]:
    df = run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, f"{len(got)} rows, no oracle"
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    want = rows_of(names, found.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    if got == want:
        return True, f"{len(got)} rows"
    first = next(((g, w) for g, w in zip(got, want) if g != w), (None, None))
    return False, f"{len(got)} vs {len(want)} rows; first difference {first}"


def main(sf_dir: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    spark, con = make_session(), connect(sf_dir)
    oracle, bad = oracle_sql(), 0
    for name, run in queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, run, oracle.get(name))
        except Exception as error:  # report every query
            ok, note = False, repr(error)[:1500]
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - began:.2f}s {note}"[:1800], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
