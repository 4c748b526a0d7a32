"""Compare every named query with its SQL answer.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(repr(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


LAST: dict[str, float] = {}
SPARK_KIND = {
    "bigint": "int", "double": "float", "string": "str", "boolean": "bool", "date": "date",
    "timestamp_ntz": "ts", "timestamp": "ts",
}
DUCK_KIND = {
    "BIGINT": "int", "DOUBLE": "float", "VARCHAR": "str", "BOOLEAN": "bool", "DATE": "date",
    "TIMESTAMP": "ts",
}


def differences(df, con, sql) -> tuple[str, int]:
    began = time.time()
    got = rows_of(df.columns, df.collect())
    LAST["collect"] = time.time() - began
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    raw = result.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}", len(got)
    for f in df.schema.fields:
        ours, theirs = SPARK_KIND.get(f.dataType.simpleString()), DUCK_KIND.get(types[f.name])
        if ours != theirs:
            return f"type of {f.name}: {f.dataType.simpleString()} / {types[f.name]}", len(got)
    want = rows_of(names, raw)
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}", len(got)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        cols = sorted(names)
        where = [(c, x, y) for c, x, y in zip(cols, *bad[0]) if x != y]
        return f"{len(bad)} rows differ, first {where}", len(got)
    return "", len(got)


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from __spark_entry__ import oracle_sql, queries
    from martworks.session import build_session

    spark = build_session(
        master="local[8]", shuffle_partitions=8,
        **{"spark.driver.memory": "8g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, answers, failed = duck(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if args and name not in args:
            continue
        began = time.time()
        built = 0.0
        try:
            df = build(spark, sf_dir)
            built = time.time() - began
            if name not in answers:
                print(f"ROWS  {name}: {df.count()} rows, {time.time() - began:.1f}s", flush=True)
                continue
            problem, n = differences(df, con, answers[name])
        except Exception as error:  # report and go on with the next query
            problem, n = f"{type(error).__name__}: {str(error)[:700]}", -1
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':5} {name}: {n} rows, {time.time() - began:.1f}s, of it Spark {built + LAST.get('collect', 0):.1f}s {problem}", flush=True)
    print(f"{failed} failed")
    return int(failed > 0)


if __name__ == "__main__":
    raise SystemExit(main())
