"""Run queries next to their SQL twins and report differences.

    python tools/check.py [folder of tables] [query names...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from docketry.queries.catalogue import oracle_sql, queries  # noqa: E402
from docketry.session import with_settings  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> str:
    df = queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracle_sql():
        return f"rows only: {got.total()}"
    cursor = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(columns)}"
    want = rows_of(columns, cursor.fetchall())
    if got == want:
        return f"ok {got.total()}"
    return f"DIFFERS {got.total()} {want.total()}\n   spark {list((got - want).items())[:2]}\n   sql   {list((want - got).items())[:2]}"[:1500]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    spark = with_settings(builder.config("spark.ui.showConsoleProgress", "false")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            outcome = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            outcome = f"FAILED {type(error).__name__} {str(error)[:600]}"
        print(f"{name:26s} {time.time() - start:6.2f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main()
