"""Consecutive ids over many partitions, and tables written and read in slices."""

from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from inkwell.operators.ids import dense_ids, next_id
from inkwell.plans import fixtures as fx
from inkwell.schemas import USERS
from inkwell.sources.tables import scan_jdbc, write_table


def test_ids_follow_the_order_across_partitions(spark, conf):
    conf(adaptive__coalescePartitions__enabled="false")
    rows = spark.range(10_000).select(
        F.col("id").alias("event_id"), (F.xxhash64("id") % 700).alias("ts")
    )
    numbered = dense_ids(rows, ["ts", "event_id"], F.lit(101))
    parts = numbered.select(F.spark_partition_id()).distinct().count()
    assert parts > 1
    got = [(r["ts"], r["event_id"], r["id"]) for r in numbered.orderBy("id").collect()]
    assert [g[2] for g in got] == list(range(101, 10_101))
    assert got == sorted(got)


def test_ids_stay_the_same_when_read_twice(spark):
    rows = spark.range(1000).select(F.col("id").alias("event_id"), F.rand().alias("ts"))
    numbered = dense_ids(rows, ["ts", "event_id"], F.lit(1))
    assert numbered.collect() == numbered.collect()


def test_no_rows(spark):
    rows = spark.createDataFrame([], "event_id long, ts long")
    assert dense_ids(rows, ["ts", "event_id"], F.lit(1)).count() == 0


def test_next_id(spark):
    ids = spark.createDataFrame([(3,), (9,)], "id long")
    one = spark.range(1)
    assert one.select(next_id(ids)).first()[0] == 10
    assert one.select(next_id(ids.filter("id > 9"))).first()[0] == 1
    assert one.select(next_id(ids.filter("id > 9"), 5)).first()[0] == 6


def test_files_of_a_table_cover_separate_ranges(spark, conf, tmp_path):
    conf(adaptive__coalescePartitions__enabled="false")
    posts = fx.posts(spark, "/root/testdata/sf0.01")
    write_table(posts, str(tmp_path / "post"))
    table = spark.read.parquet(str(tmp_path / "post"))
    ranges = sorted(
        tuple(r)
        for r in table.groupBy(F.input_file_name()).agg(F.min("id"), F.max("id")).drop("input_file_name()").collect()
    )
    assert len(ranges) == 8
    assert all(before[1] < after[0] for before, after in zip(ranges, ranges[1:]))
    assert table.count() == posts.count()
    with pytest.raises(AnalysisException):
        write_table(posts, str(tmp_path / "post"))


def test_database_table_is_read_in_slices(spark):
    asked = {}

    def jdbc(url, table, **options):
        asked.update(options, url=url, table=table)
        return spark.createDataFrame(
            [(1, "a", "x", "extra")], "id int, username string, password string, more string"
        )

    session = SimpleNamespace(read=SimpleNamespace(jdbc=jdbc))
    users = scan_jdbc(session, "jdbc:x", "user", USERS, (1, 1000), 20, {"user": "reader"})
    assert users.collect() == [(1, "a", "x")]
    assert dict(users.dtypes)["id"] == "bigint"
    assert (asked["lowerBound"], asked["upperBound"], asked["numPartitions"]) == (1, 1000, 20)
