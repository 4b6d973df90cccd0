"""Run named queries in Spark and their oracle SQL in DuckDB, compare results.

Usage: python -m tests.oracle_harness [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(dtype) -> str:
    s = str(dtype).lower()
    if "int" in s:
        return "int"
    if "float" in s or "double" in s:
        return "float"
    if "bool" in s:
        return "bool"
    return "other"


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"rows {len(spark_pdf)} vs {len(duck_pdf)}"
    kinds = {c: (_kind(spark_pdf[c].dtype), _kind(duck_pdf[c].dtype)) for c in spark_pdf.columns}
    bad = {c: k for c, k in kinds.items() if k[0] != k[1] and not (len(spark_pdf) == 0)}
    a, b = canon(spark_pdf), canon(duck_pdf)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, first: {diff}"
    if bad:
        return True, f"ok (dtype note {bad})"
    return True, "ok"


def run(spark, sf_dir: str, names=None) -> dict[str, tuple[bool, str]]:
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            out[name] = (False, f"spark error {type(e).__name__}: {str(e)[:300]}")
            print(name, out[name], flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            out[name] = (True, f"rows-only {len(sp)}")
        else:
            try:
                dk = con.execute(sqls[name]).df()
                out[name] = compare(sp, dk)
            except Exception as e:  # noqa: BLE001
                out[name] = (False, f"duckdb error {type(e).__name__}: {str(e)[:300]}")
        print(f"{name}: {out[name]} rows={len(sp)} spark={t1 - t0:.1f}s", flush=True)
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from corpusmill.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    res = run(get_session(), sf, names)
    bad = {k: v for k, v in res.items() if not v[0]}
    print(f"{len(res) - len(bad)}/{len(res)} ok; failing: {sorted(bad)}")
