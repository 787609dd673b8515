"""Run registered queries next to their SQL and compare the results.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def normal(pdf: pd.DataFrame) -> pd.DataFrame:
    cols = sorted(pdf.columns)
    out = pdf[cols].copy()
    for c in cols:
        if out[c].dtype.kind in "iuf":
            out[c] = out[c].astype(float)
        else:
            out[c] = [None if v is None or (isinstance(v, float) and v != v) or v is pd.NaT else str(v) for v in out[c]]
    out = out.astype(object).where(out.notna(), None)
    keys = out.apply(lambda row: tuple((v is None, str(v)) for v in row), axis=1)
    return out.iloc[keys.argsort() if len(out) else []].reset_index(drop=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = normal(got), normal(want)
    for c in a.columns:
        bad = [i for i, (x, y) in enumerate(zip(a[c], b[c])) if x != y]
        if bad:
            i = bad[0]
            return f"{c}: {len(bad)} differ, first {a[c][i]!r} vs {b[c][i]!r}\n{a.iloc[[i]]}\n{b.iloc[[i]]}"
    for c in got.columns:
        gi, wi = got[c].dtype.kind in "iu", want[c].dtype.kind in "iu"
        if gi != wi and got[c].notna().all() and len(got):
            return f"{c}: type {got[c].dtype} vs {want[c].dtype}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from orderpulse.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    spark = local_session(cpus=8)
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            got = queries[name](spark, folder).toPandas()
            took = time.time() - start
            if name in oracle:
                t = time.time()
                want = con.execute(oracle[name]).df()
                problem = compare(got, want)
                verdict = f"ok ({len(got)} rows, sql {time.time() - t:.1f}s)" if problem is None else f"MISMATCH {problem}"
            else:
                verdict = f"rows only ({len(got)})" if len(got) else "EMPTY"
        except Exception as err:  # noqa: BLE001
            took = time.time() - start
            verdict = f"ERROR {type(err).__name__}: {str(err)[:1500]}"
        failed += not verdict.startswith(("ok", "rows only"))
        print(f"{took:6.1f}s {name}: {verdict}", flush=True)
    print(f"{len(names) - failed}/{len(names)} good")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
