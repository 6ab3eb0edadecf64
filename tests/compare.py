"""Run registered queries next to their SQL in DuckDB and report differences.

``python -m tests.compare SF_DIR [name …]``
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v: object) -> object:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool) or isinstance(v, str):
        return v
    if isinstance(v, (int, float)):
        return float(v) + 0.0
    return str(v)


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(table, key=lambda r: [str(x) for x in r])


def difference(df, con: duckdb.DuckDBPyConnection, text: str) -> str | None:
    cols_s, rows_s = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(text)
    cols_d, rows_d = rows_of([d[0] for d in cur.description], cur.fetchall())
    if cols_s != cols_d:
        return f"columns {cols_s} / {cols_d}"
    if len(rows_s) != len(rows_d):
        return f"rows {len(rows_s)} / {len(rows_d)}"
    wrong = [(a, b) for a, b in zip(rows_s, rows_d) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(rows_s)} rows differ, first {wrong[0][0]} / {wrong[0][1]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark = make_session()
    con = database(sf_dir)
    texts = entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            df = build(spark, sf_dir)
            if name in texts:
                problem = difference(df, con, texts[name])
                note = f"{len(df.columns)} columns"
            else:
                problem, note = None, f"rows only: {df.count()}"
        except Exception as e:  # report and go on
            problem, note = f"{type(e).__name__}: {str(e)[:600]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:26s} {time.time() - begin:6.2f}s "
              f"{problem or note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
