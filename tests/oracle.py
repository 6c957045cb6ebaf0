"""Run queries in Spark and their oracles in DuckDB, and compare whole results."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def cell(x):
        if x is None or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
            return (0, "")
        if isinstance(x, bool):
            return (1, str(x))
        if isinstance(x, float):
            return (2, repr(x + 0.0))
        return (3, str(x))

    return sorted(tuple(cell(v) for v in row) for row in df.astype(object).itertuples(index=False))


def _kind(dtype: str) -> str:
    return {"int": "int32", "bigint": "int64", "double": "double", "string": "string", "boolean": "bool"}.get(dtype, dtype)


_DUCK = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "bool"}


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    got_df = fn(spark, sf_dir)
    got = pd.DataFrame([tuple(r) for r in got_df.collect()], columns=got_df.columns, dtype=object)
    if sql is None:
        return None if len(got) else "no rows"
    rel = con.execute(sql)
    cols = [c[0] for c in rel.description]
    want = pd.DataFrame(rel.fetchall(), columns=cols, dtype=object)
    if sorted(cols) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(cols)}"
    duck = {c[0]: _DUCK.get(str(c[1]), str(c[1])) for c in rel.description}
    mine = {n: _kind(t) for n, t in got_df.dtypes}
    if duck != mine:
        return "types " + str({k: (mine[k], duck[k]) for k in mine if mine[k] != duck[k]})
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = _canonical(got), _canonical(want)
    if a == b:
        return None
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, e.g. {bad[0]}"


def main(argv):
    sys.path.insert(0, "/root/repo")
    from foldmark.queries import all_oracles, all_queries
    from foldmark.session import local_session

    sf_dir = argv[0]
    spark = local_session(8)
    con = connect(sf_dir)
    queries, oracles = all_queries(), all_oracles()
    names = [n for n in queries if not argv[1:] or any(n.startswith(p) for p in argv[1:])]
    failed = 0
    for n in names:
        t0 = time.time()
        try:
            msg = compare(spark, con, n, queries[n], oracles.get(n), sf_dir)
        except Exception as e:  # report and go on with the other queries
            msg = f"{type(e).__name__}: {str(e)[:700]}"
        failed += msg is not None
        print(f"{'ok  ' if msg is None else 'FAIL'} {n} {'' if n in oracles else '(rows)'} {time.time() - t0:.1f}s {msg or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])
