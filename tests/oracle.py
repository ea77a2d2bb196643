"""Runs a query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def normal(df: pd.DataFrame) -> list[tuple]:
    def text(v) -> str:
        if v is None or (not hasattr(v, "__len__") and pd.isna(v)):
            return "<null>"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v) + 0.0)  # no signed zero
        return str(v).removesuffix(" 00:00:00")

    return sorted(tuple(text(v.item() if hasattr(v, "item") else v) for v in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


def compare(spark, query, sql: str) -> None:
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got, want = query(spark, SF).toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)
