"""Run registered queries against their SQL in DuckDB and report differences.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from barline.session import get_spark
from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return None
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return bool(v)
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return repr(float(v))
        return str(pd.Timestamp(v)) if hasattr(v, "year") else v

    df = df[sorted(df.columns)]
    columns = [[plain(v) for v in df[c].astype(object)] for c in df.columns]
    return sorted(zip(*columns), key=repr)


def compare(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str:
    """Empty text if both hold the same rows."""
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(duck_df.columns)}"
    a, b = _rows(spark_df), _rows(duck_df)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main(sf_dir: str, names: list[str]) -> int:
    spark = get_spark(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                         "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or list(QUERIES):
        t0 = time.time()
        try:
            got = QUERIES[name](spark, sf_dir)
            types = dict(got.dtypes)
            got = got.toPandas()
            t1 = time.time()
            if name in ORACLES:
                want = con.execute(ORACLES[name]).df()
                verdict = compare(got, want) or "ok"
            else:
                verdict = "rows only"
        except Exception as e:  # noqa: BLE001 - report and go on
            t1, verdict, got, types = time.time(), f"ERROR {str(e)[:500]}", [], {}
        bad += verdict not in ("ok", "rows only")
        print(f"{name}: {verdict} rows={len(got)} spark={t1 - t0:.2f}s duck={time.time() - t1:.2f}s",
              flush=True)
        if verdict.startswith(("columns", "rows ")) and verdict != "rows only":
            print(types)
    print(f"{bad} wrong")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1].rstrip("/"), sys.argv[2:]) else 0)
