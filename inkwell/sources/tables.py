"""Reading, loading and resetting the account and post tables."""

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.schemas import POSTS, USERS


def _typed(df: DataFrame, schema: StructType, columns: Mapping[str, str]) -> DataFrame:
    return df.select(
        *[
            F.expr(columns.get(f.name, f.name)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def scan_users(spark: SparkSession, path: str, **columns: str) -> DataFrame:
    """Accounts as id, username, password.

    `columns` gives the SQL expression for a column the files hold under another name.
    """
    return _typed(spark.read.parquet(path), USERS, columns)


def scan_posts(spark: SparkSession, path: str, **columns: str) -> DataFrame:
    """Posts as id, author_id, created, title, body; `columns` as in scan_users."""
    return _typed(spark.read.parquet(path), POSTS, columns)


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    schema: StructType,
    id_range: tuple[int, int],
    pieces: int,
    properties: Mapping[str, str],
) -> DataFrame:
    """A database table read by `pieces` tasks, each taking a slice of the id range."""
    lower, upper = id_range
    df = spark.read.jdbc(
        url,
        table,
        column="id",
        lowerBound=lower,
        upperBound=upper,
        numPartitions=pieces,
        properties=dict(properties),
    )
    return _typed(df, schema, {})


def load_inline_rows(
    spark: SparkSession, rows: Sequence[Mapping[str, object]], schema: StructType
) -> DataFrame:
    """A handful of literal rows as a table; unknown or missing columns are refused.

    They become part of the plan, so Catalyst knows how few they are.
    """
    names = schema.fieldNames()
    required = {f.name for f in schema.fields if not f.nullable}
    for row in rows:
        if unknown := set(row) - set(names):
            raise ValueError(f"unknown columns: {sorted(unknown)}")
        if missing := {c for c in required if row.get(c) is None}:
            raise ValueError(f"columns without a value: {sorted(missing)}")
    if not rows:
        return spark.createDataFrame([], schema)
    columns = {name: [row.get(name) for row in rows] for name in names}
    return spark.createDataFrame(pa.table(columns), schema)


def write_table(df: DataFrame, path: str, key: str = "id", lookups: Mapping[str, int] | None = None) -> None:
    """Write a new table, or a changed one beside the one it was made from.

    Each file covers its own range of `key`, so that a lookup by key skips the others. For
    columns that are looked up by a value the order says nothing about, `lookups` gives the
    number of distinct values to expect in a row group: its bloom filter then tells nearly
    always whether a value is in there.
    """
    writer = df.repartitionByRange(key).sortWithinPartitions(key).write
    for column, distinct in (lookups or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    writer.parquet(path)


def point_lookup(table: DataFrame, column: str, values: Sequence) -> DataFrame:
    """The rows of a stored table with one of a few values, NULL never being one.

    As equalities they reach the scan, which skips files and row groups by key range and by the
    bloom filters of write_table; for many values join with a table of them.
    """
    wanted = [F.col(column) == value for value in values if value is not None]
    return table.filter(reduce(Column.__or__, wanted, F.lit(False)))


def reset_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Replace both tables under `path` by empty ones, posts before the users they refer to."""
    empty = {}
    for name, schema in (("post", POSTS), ("user", USERS)):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{name}")
        empty[name] = spark.read.schema(schema).parquet(f"{path}/{name}")
    return empty
