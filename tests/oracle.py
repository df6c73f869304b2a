"""Run registered queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from leadspark.session import configure  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def local_session(cores: int = 8, partitions: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("leadspark-test")
    spark = (
        configure(builder)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE", "float": "FLOAT",
}


def compare(spark: SparkSession, con, run, sql: str | None, sf_dir: str) -> tuple[str, int]:
    """``("ok" or what differs, rows)``."""
    df = run(spark, sf_dir)
    got = _rows(df.columns, df.collect())
    if sql is None:
        return "no sql", len(got)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    if got != expected:
        pairs = [(a, b) for a, b in zip(got, expected) if a != b][:2]
        return f"{len(got)} rows != {len(expected)}; {str(pairs)[:1500]}", len(got)
    odd = {c: (k, kinds[c]) for c, k in df.dtypes if _KINDS.get(k) != kinds[c]}
    return (f"types {odd}" if odd else "ok"), len(got)


def main() -> None:
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = local_session(), duck(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            verdict, n = compare(spark, con, run, sql.get(name), sf_dir)
        except Exception as failure:  # noqa: BLE001
            verdict, n = f"{type(failure).__name__}: {str(failure)[:700]}", -1
        bad += verdict != "ok"
        print(f"{name:24s} {n:7d} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()
