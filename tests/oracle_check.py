"""Compare catalogue queries with their SQL counterparts in DuckDB.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(table) -> list[tuple]:
    """Rows with columns in name order, sorted; floats as they are."""
    table = table.select(sorted(table.column_names))
    rows = list(zip(*[table.column(i).to_pylist() for i in range(table.num_columns)]))
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def compare(spark_table, duck_table) -> str | None:
    """None when equal, else what differs."""
    if sorted(spark_table.column_names) != sorted(duck_table.column_names):
        return f"columns {spark_table.column_names} vs {duck_table.column_names}"
    types = {n: (str(spark_table.schema.field(n).type), str(duck_table.schema.field(n).type))
             for n in spark_table.column_names}
    if spark_table.num_rows != duck_table.num_rows:
        return f"{spark_table.num_rows} vs {duck_table.num_rows} rows"
    mine, theirs = _rows(spark_table), _rows(duck_table)
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, first {bad[0]}"
    odd = {n: t for n, t in types.items() if t[0].replace("large_", "") != t[1].replace("large_", "")}
    if odd:
        return f"types {odd}"
    return None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    from murmuration.plans import catalog, oracle
    from murmuration.runtime import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls, failed = oracle.oracle_sql(), 0
    for name, query in catalog.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            mine = query(spark, sf_dir).toArrow()
            took, start = time.time() - start, time.time()
            theirs = con.execute(sqls[name]).to_arrow_table()
            verdict = compare(mine, theirs)
        except Exception as error:  # report and go on with the next query
            took, mine, verdict = time.time() - start, None, f"{type(error).__name__}: {str(error)[:600]}"
        failed += verdict is not None
        print(f"{name:24s} {took:6.2f}s sql {time.time() - start:5.2f}s "
              f"{mine.num_rows if mine is not None else '-':>8} {verdict or 'ok'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
