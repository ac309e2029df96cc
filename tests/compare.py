"""Compare registered queries with their SQL twins: ``python tests/compare.py sf0.01 [name prefix ...]``."""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


SPENT = {}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    if hasattr(v, "is_finite"):
        return round(float(v), 6) + 0.0
    return v


def rows_of(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr), sorted(names)


def oracle_connection(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, folder, query):
    """Empty text when equal, else what differs."""
    from pilotlamp.plans.registry import Tables
    from pilotlamp.session import drop_tables

    t = time.time()
    df = query.build(Tables(spark, folder))
    data = df.collect()
    SPENT[query.name] = time.time() - t
    drop_tables(spark)
    got, got_names = rows_of(df.columns, data)
    if query.oracle is None:
        return "" if got else "no rows"
    cur = con.execute(query.oracle)
    names = [d[0] for d in cur.description]
    want, want_names = rows_of(names, cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got == want:
        return "" if got else "both empty"
    have, need = set(got), set(want)
    only = [r for r in got if r not in need][:3]
    miss = [r for r in want if r not in have][:3]
    return f"{len(got)} rows != {len(want)} rows\n  columns   {got_names}\n  only here {only}\n  missing   {miss}"


if __name__ == "__main__":
    from pilotlamp.plans import load_all
    from pilotlamp.plans.registry import QUERIES
    from pilotlamp.session import build_session

    load_all()
    folder = f"/root/testdata/{sys.argv[1]}"
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--conf spark.ui.showConsoleProgress=false pyspark-shell")
    spark = build_session(master="local[8]", partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    bad = 0
    for name, q in QUERIES.items():
        if len(sys.argv) > 2 and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        t = time.time()
        try:
            problem = compare(spark, con, folder, q)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {SPENT.get(name, -1):.1f}s of {time.time() - t:.1f}s {'' if q.oracle else '(rows only)'} {problem}",
              flush=True)
    print("failed:", bad)
