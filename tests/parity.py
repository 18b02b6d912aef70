"""Run catalog queries and their SQL side by side and compare whole results."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    return cols, {c: t for c, t in df.dtypes}, sorted(rows, key=repr)


def duck_rows(con, text):
    cur = con.execute(text)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in cur.fetchall()]
    return [names[i] for i in order], types, sorted(rows, key=repr)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def compare(spark, con, sf_dir, fn, text):
    """None if equal, else what differs."""
    cols, types, rows = spark_rows(fn(spark, sf_dir))
    dcols, dtypes, drows = duck_rows(con, text)
    if cols != dcols:
        return f"columns {cols} / {dcols}"
    off = {c: (types[c], dtypes[c]) for c in cols if KINDS.get(types[c]) != dtypes[c]}
    if off:
        return f"types {off}"
    if len(rows) != len(drows):
        return f"rows {len(rows)} / {len(drows)}"
    bad = [(a, b) for a, b in zip(rows, drows) if a != b]
    return f"{len(bad)} of {len(rows)} rows, e.g. {bad[:2]}" if bad else None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from fareloom.session import build_session

    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or list(queries):
        start = time.time()
        try:
            if name in oracles:
                why = compare(spark, con, sf_dir, queries[name], oracles[name])
            else:
                why = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as e:  # report and go on
            why = f"{type(e).__name__}: {str(e)[:600]}"
        failed += why is not None
        mark = "ok" if why is None else "BAD"
        print(f"{mark:4}{name:36}{time.time() - start:7.2f}s {why or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
