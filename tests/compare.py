"""Compare a Spark result with the SQL twin's, regardless of row order."""

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row[n] for n in names) for row in df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows
