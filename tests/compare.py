"""Run registered queries against their SQL in DuckDB: ``python tests/compare.py [sf] [name ...]``."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _canon(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for row in df.itertuples(index=False, name=None):
        rows.append(tuple(None if v is None or v is pd.NaT or v is pd.NA or v != v else v for v in row))
    return sorted(rows, key=repr)


def differences(spark, con, name, sf_dir):
    """Empty text when the query equals its SQL, else what differs."""
    got = entry.queries()[name](spark, sf_dir).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    kinds = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns if str(got[c].dtype) != str(want[c].dtype)}
    a, b = _canon(got.astype(object)), _canon(want.astype(object))
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}; only here {[r for r in a if r not in set(b)][:2]}; only there {[r for r in b if r not in set(a)][:2]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ ({sorted(got.columns)}), e.g. {bad[0]}"
    return f"types {kinds}" if kinds else ""


if __name__ == "__main__":
    from swathbook.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    path = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(path)
    wanted = sys.argv[2:] or list(entry.queries())
    for name in wanted:
        t = time.time()
        try:
            if name in entry.oracle_sql():
                verdict = differences(spark, con, name, path)
            else:
                verdict = f"rows only: {entry.queries()[name](spark, path).count()}"
        except Exception as exc:  # noqa: BLE001
            verdict = f"FAILED {type(exc).__name__}: {str(exc)[:700]}"
        print(f"{name:28s} {time.time() - t:6.1f}s {verdict or 'equal'}", flush=True)
