"""Compare registered queries with their SQL: ``python tests/check_oracle.py [dir] [name ...]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    """An empty text if both agree exactly, else what differs."""
    ours = canonical(entry.queries()[name](spark, sf_dir).toPandas())
    theirs = canonical(con.execute(entry.oracle_sql()[name]).df())
    if list(ours.columns) != list(theirs.columns):
        return f"columns {list(ours.columns)} / {list(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for c in ours.columns:
        a, b = ours[c], theirs[c]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            i = (~same).idxmax()
            return f"{(~same).sum()} values of {c}, first {a[i]!r} / {b[i]!r}"
        if a.dtype.kind != b.dtype.kind and not a.isna().any():
            return f"type of {c}: {a.dtype} / {b.dtype}"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.oracle_sql())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in wanted:
        start = time.time()
        try:
            found = compare(spark, con, name, sf_dir)
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {time.time() - start:6.2f}s {name} {found}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
