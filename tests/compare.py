"""Runs registered queries next to their SQL and compares the rows.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return int(number) if number.is_integer() else round(number, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(con, sql: str, df) -> str | None:
    found = con.execute(sql)
    wanted_columns = [c[0] for c in found.description]
    wanted = rows_of(wanted_columns, found.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(wanted_columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(wanted_columns)}"
    if got == wanted:
        return None if wanted else "both empty"
    only_got, only_wanted = set(got) - set(wanted), set(wanted) - set(got)
    return (
        f"{len(got)} rows, expected {len(wanted)}; {len(only_got)} only here"
        f" {sorted(only_got, key=repr)[:2]}, {len(only_wanted)} only expected"
        f" {sorted(only_wanted, key=repr)[:2]}"
    )


def main() -> None:
    from bench import session
    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = session()
    con = connect(folder)
    sql, bad = oracle_sql(), 0
    for name, build in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sql:
                result = difference(con, sql[name], build(spark, folder)) or "ok"
            else:
                result = f"ok ({len(build(spark, folder).collect())} rows, no SQL)"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not result.startswith("ok")
        print(f"{name:32s} {time.time() - start:6.2f}s {result}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
