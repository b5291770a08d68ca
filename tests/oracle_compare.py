"""Run registered queries against their DuckDB oracle, as the driver does.

    python -m tests.oracle_compare /root/testdata/sf0.01 [name ...]

``FG_SHUFFLE_PARTITIONS`` sets the session's shuffle partitions (default 8).
"""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 12)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, dict]:
    import __spark_entry__ as entry

    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or list(sql):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = rows_of(s_cols, [tuple(r) for r in df.collect()])
        t1 = time.time()
        res = con.execute(sql[name])
        d_cols = [c[0] for c in res.description]
        d_rows = rows_of(d_cols, res.fetchall())
        ok = sorted(s_cols) == sorted(d_cols) and s_rows == d_rows
        report[name] = {
            "ok": ok,
            "rows": (len(s_rows), len(d_rows)),
            "cols": (sorted(s_cols), sorted(d_cols)),
            "sec": round(t1 - t0, 2),
        }
        if verbose:
            print(name, "OK" if ok else "MISMATCH", report[name]["rows"], report[name]["sec"], flush=True)
            if not ok:
                print("  spark cols", s_cols, "duck cols", d_cols)
                diff_s = [r for r in s_rows if r not in set(d_rows)][:5]
                diff_d = [r for r in d_rows if r not in set(s_rows)][:5]
                print("  only spark", diff_s)
                print("  only duck ", diff_d)
    return report


if __name__ == "__main__":
    import os
    import tempfile

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="fg-cmp-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", os.environ.get("FG_SHUFFLE_PARTITIONS", "8"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "wh"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    rep = compare(spark, sys.argv[1], sys.argv[2:] or None)
    bad = [k for k, v in rep.items() if not v["ok"]]
    print("mismatched:", bad)
    sys.exit(1 if bad else 0)
