"""Run registered queries against their SQL in DuckDB.

python -m tests.compare [sf] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{DATA}/sf{sf}/{name}.parquet')")
    return con


def kind(dtype) -> str:
    return "number" if dtype.kind in "iu" else dtype.kind


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for row in df.itertuples(index=False, name=None):
        rows.append(tuple("" if v is None or (not isinstance(v, list) and v != v) else _text(v) for v in row))
    return sorted(rows)


def _text(v) -> str:
    if isinstance(v, float):
        return repr(v + 0.0)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    return str(v)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None where both hold the same rows, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    a, b = canonical(got), canonical(want)
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def integral(df: pd.DataFrame, types: dict[str, str]) -> pd.DataFrame:
    for name, typ in types.items():
        if typ in ("tinyint", "smallint", "int", "bigint"):
            df[name] = df[name].astype("Int64").astype(object)
    return df


def run(spark, name: str, entry, sf: str, con) -> tuple[str, float]:
    start = time.time()
    df = entry.run(spark, f"{DATA}/sf{sf}")
    rows = df.collect()
    took = time.time() - start
    got = pd.DataFrame([list(r) for r in rows], columns=df.columns, dtype=object)
    if entry.sql is None:
        return (f"rows {len(got)}" if len(got) else "EMPTY"), took
    result = con.execute(entry.sql)
    want = pd.DataFrame(result.fetchall(), columns=[d[0] for d in result.description], dtype=object)
    return difference(got, want) or "ok", took


if __name__ == "__main__":
    from checks import REGISTRY
    from tidemark.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = get_spark("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name in names:
        if name not in REGISTRY and not any(k.startswith(name) for k in REGISTRY):
            print("unknown", name)
        for key in [k for k in REGISTRY if k == name or (len(sys.argv) > 2 and k.startswith(name))]:
            try:
                text, took = run(spark, key, REGISTRY[key], sf, con)
            except Exception as error:  # the table goes on with the next query
                text, took = f"{type(error).__name__}: {str(error)[:600]}", 0.0
            good = text == "ok" or text.startswith("rows ") and "/" not in text
            failed += not good
            print(f"{'  ' if good else 'X '}{key:40s} {took:6.1f}s  {text[:900]}", flush=True)
    print("failed", failed, "of", len(names))
