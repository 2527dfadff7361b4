"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, int):
        return f"i{v}"
    if isinstance(v, float):
        if math.isnan(v) or math.isinf(v):
            return f"f{v}"
        return f"f{float(v) + 0.0!r}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return f"{type(v).__name__}:{v}"


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """'' when both give the same rows, else what differs."""
    got_cols, got = table_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = table_of([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return len(got), f"columns {got_cols} <> {want_cols}"
    if got == want:
        return len(got), ""
    a, b = set(got), set(want)
    return len(got), (
        f"rows {len(got)} vs {len(want)}; only spark {len(a - b)} {sorted(a - b)[:3]}; only sql {len(b - a)} {sorted(b - a)[:3]}"
    )


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from sessionloom.session import local_session

    sf = os.environ.get("SF", "0.01")
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in queries:
        if argv and not any(name.startswith(a) for a in argv):
            continue
        t = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sqls:
                n, diff = compare(df, con, sqls[name])
                mark = "OK  " if not diff else "DIFF"
            else:
                n, diff, mark = df.count(), "", "ROWS"
        except Exception as e:  # noqa: BLE001
            n, diff, mark = -1, f"{type(e).__name__}: {str(e)[:900]}", "FAIL"
        bad += bool(diff)
        print(f"{mark} {name} rows={n} {time.time() - t:.1f}s {diff}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
