"""Side-by-side check of registered queries against their DuckDB SQL twins.

Usage: python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return False, f"columns {sorted(spark_pdf.columns)} vs {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return False, f"rows {len(spark_pdf)} vs {len(sql_pdf)}"
    a, b = canon(spark_pdf), canon(sql_pdf)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return False, f"row {i}: {x} vs {y}"
    return True, f"{len(a)} rows"


def spark_pdf(df) -> pd.DataFrame:
    rows = df.collect()
    return pd.DataFrame([r.asDict() for r in rows], columns=df.columns)


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from kestrel.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(entry.queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sp = spark_pdf(qs[n](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt = time.time() - t0
        if n not in sqls:
            print(f"ROWS {n}: {len(sp)} rows ({dt:.1f}s, no oracle)")
            continue
        try:
            dq = con.execute(sqls[n]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        ok, msg = compare(sp, dq)
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {n}: {msg} ({dt:.1f}s)")
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
