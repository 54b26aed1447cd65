"""Run registered queries against their SQL: ``python tests/compare.py [sf_dir] [name...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if value is None:
        return "~null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, build, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    df = build(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return True, f"{len(got)} rows, no SQL"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got == want:
        return True, f"{len(got)} rows"
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return False, f"rows {len(got)} vs {len(want)}\n   spark {only_got}\n   sql   {only_want}"


def main() -> None:
    import __spark_entry__ as entry
    from curvewright.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    sqls, bad = entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            ok, note = compare(spark, con, name, build, sqls.get(name), sf_dir)
        except Exception as exc:  # noqa: BLE001
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:1500]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - began:.1f}s {note}", flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()
