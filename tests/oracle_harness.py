"""Compare catalogue queries with their DuckDB oracles, the way the driver
does: same column names, same row count, same multiset of rows."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return v.item()
        except Exception:  # noqa: BLE001
            return v
    return v


def rows_of(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols, s_rows = rows_of(spark_df.toPandas())
    o_cols, o_rows = rows_of(con.execute(sql).df())
    if s_cols != o_cols:
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    if len(s_rows) != len(o_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(o_rows)}"
    for a, b in zip(s_rows, o_rows):
        if a != b:
            return False, f"first differing row: spark={a} oracle={b}"
    return True, f"{len(s_rows)} rows"
