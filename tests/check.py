"""Compare queries with their SQL twins: ``python tests/check.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "item"):
        v = v.item()
    return v


def rows_of(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_cell(r[i]) for i in order)) for r in rows)


def compare(spark, con, name: str, query, sql: str | None, sf: str) -> tuple[bool, str]:
    start = time.time()
    df = query(spark, sf)
    got_rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return True, f"{name}: rows only, {len(got_rows)} rows, {took:.1f}s"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want_rows = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"{name}: columns {sorted(df.columns)} != {sorted(columns)}"
    types = dict(zip(columns, [str(d[1]) for d in result.description]))
    odd = {c: (t, types[c]) for c, t in df.dtypes if SQL_TYPES.get(t) != types[c]}
    if odd:
        return False, f"{name}: types differ {odd}"
    got, want = rows_of(df.columns, got_rows), rows_of(columns, want_rows)
    if got == want:
        return True, f"{name}: equal, {len(got)} rows, {took:.1f}s"
    extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return False, (
        f"{name}: differs, {len(got)} / {len(want)} rows, {sorted(df.columns)} {df.dtypes} {types}\n"
        f"   only Spark ({len(extra)}): {extra[:4]}\n   only SQL ({len(missing)}): {missing[:4]}"
    )


def main() -> None:
    import __spark_entry__ as entry
    from linewatch.session import build_session, release

    sf = "/root/testdata/sf" + (sys.argv[1] if len(sys.argv) > 1 else "0.01")
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": "file:" + tempfile.mkdtemp(prefix="check-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sql = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            ok, text = compare(spark, con, name, query, sql.get(name), sf)
        except Exception as e:  # report and go on with the next query
            ok, text = False, f"{name}: {type(e).__name__} {str(e)[:1500]}"
        bad += not ok
        print(("ok   " if ok else "FAIL ") + text, flush=True)
    release(spark)
    print(f"{bad} failures")


if __name__ == "__main__":
    main()
