"""Run the catalog against DuckDB: ``python -m verification.check [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification.oracles import oracle_sql
from verification.queries import queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _types(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Columns whose declared types differ."""
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{c} {t} vs {want.get(c)}" for c, t in df.dtypes if TYPES.get(t, t) != want.get(c)]


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12)
    return type(a) is type(b) and a == b


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    """Empty when rows, names, Python types and values agree."""
    df = queries()[name](spark, sf_dir)
    names = sorted(df.columns)
    sql = oracle_sql().get(name)
    if sql is None:
        return f"no oracle, {df.count()} rows"
    differ = _types(df, con, sql)
    if differ:
        return f"types {differ}"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} vs {sorted(columns)}"
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=_key)
    order = [columns.index(c) for c in names]
    want = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for g, w in zip(got, want):
        bad = [(c, x, y) for c, x, y in zip(names, g, w) if not _same(x, y)]
        if bad:
            return f"{bad} in {g}"
    return "" if got else "no rows"


def session(cores: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("tamiz-check")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark, con, failed = session(), connect(sf_dir), 0
    for name in names:
        start = time.perf_counter()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as e:  # report every query, then fail
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem) and not problem.startswith("no oracle")
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.perf_counter() - start:.2f}s {problem}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
