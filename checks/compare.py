"""Run every registered query against its SQL and report the differences.

    python -m checks.compare [data folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks import oracle, queries
from ledgerloom.session import build_session

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """None if both hold the same rows in any order, else what differs first."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"

    def keyed(df: pd.DataFrame) -> pd.Series:
        def one(v) -> str:
            if v is None or v is pd.NA or v is pd.NaT or v != v:
                return "-"
            if isinstance(v, (bool, str)):
                return str(v)
            return repr(float(v))

        texts = {c: df[c].astype(object).map(one) for c in sorted(df.columns)}
        return pd.DataFrame(texts).agg("|".join, axis=1).sort_values(ignore_index=True)

    if not len(spark_rows):
        return None
    left, right = keyed(spark_rows), keyed(sql_rows)
    if (left == right).all():
        return None
    only_left = sorted(set(left) - set(right))[:3]
    only_right = sorted(set(right) - set(left))[:3]
    return f"{int((left != right).sum())} places, spark {only_left} / sql {only_right}"


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    registered, statements = queries.registered(), oracle.statements()
    bad = 0
    for name in names or registered:
        start = time.time()
        got = registered[name](spark, sf_dir).toPandas()
        middle = time.time()
        want = con.execute(statements[name]).df()
        found = difference(got, want)
        bad += found is not None
        print(
            f"{'ok ' if found is None else 'BAD'} {name:26s} {len(got):7d} rows "
            f"{middle - start:6.2f}s sql {time.time() - middle:5.2f}s {found or ''}",
            flush=True,
        )
    print(f"{bad} differ; without SQL: {sorted(set(registered) - set(statements))}")
    return bad


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(min(main(folder, sys.argv[2:]), 1))
