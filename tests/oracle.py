"""Side-by-side check of queries against their SQL, also usable as a script."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([names[i] for i in order]), sorted(
        (repr([_value(r[i]) for i in order]) for r in rows)
    )


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    names, got = rows_of(df.columns, df.collect())
    if sql is None:
        return f"rows only ({len(got)})" if got else "EMPTY"
    result = con.execute(sql)
    cols = [d[0] for d in result.description]
    want_names, want = rows_of(cols, result.fetchall())
    if names != want_names:
        return f"FAIL columns {names} vs {want_names}"
    if len(got) != len(want):
        return f"FAIL rows {len(got)} vs {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"FAIL value\n   spark {a[:600]}\n   sql   {b[:600]}"
    return f"ok ({len(got)})"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    from newsflow.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    wanted = sys.argv[1:]
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, query, sqls.get(name), sf)
        except Exception as problem:  # noqa: BLE001
            verdict = f"ERROR {str(problem)[:700]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
