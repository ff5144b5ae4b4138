"""Lookups of a few values skip row groups of a stored table."""

import pytest
from pyspark.sql import functions as F

from inkwell.sources.tables import point_lookup, write_table

ROWS = 200_000


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookups") / "user")
    users = spark.range(ROWS).select("id", F.md5(F.col("id").cast("string")).alias("username"), F.lit("p").alias("password"))
    spark.conf.set("parquet.block.size", 256 * 1024)
    try:
        write_table(users, path, lookups={"username": 10_000})
    finally:
        spark.conf.unset("parquet.block.size")
    return spark.read.parquet(path)


def looked_up(df):
    """The rows found, and how many the scan has read for them."""
    rows, nodes = df.collect(), [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Scan"):
            return rows, node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]


def name(spark, i):
    return spark.range(1).select(F.md5(F.lit(str(i)))).first()[0]


def test_present_names(spark, table):
    rows, read = looked_up(point_lookup(table, "username", [name(spark, 77_777), name(spark, 5)]))
    assert sorted(r.id for r in rows) == [5, 77_777] and 0 < read < ROWS / 5


def test_absent_names(spark, table):
    # Within the range of all names, so only the filters tell.
    rows, read = looked_up(point_lookup(table, "username", ["7" * 32, "c" * 32, None]))
    assert rows == [] and read < ROWS / 5


def test_ids(spark, table):
    rows, read = looked_up(point_lookup(table, "id", [123, 199_999, 10**12]))
    assert sorted(r.id for r in rows) == [123, 199_999] and read < ROWS / 5


def test_no_values(spark, table):
    assert point_lookup(table, "username", []).isEmpty() and point_lookup(table, "username", [None]).isEmpty()
