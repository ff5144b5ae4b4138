"""A table changed in place: the same rows as all at once, and other files left alone."""

import hashlib
from pathlib import Path

import pytest
from compare import spark_rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from inkwell.operators import edits, rewrite
from inkwell.plans import fixtures as fx

SF_DIR = "/root/testdata/sf0.001"
SIZE = 100


@pytest.fixture(scope="module")
def posts(spark):
    return fx.posts(spark, SF_DIR)


@pytest.fixture(scope="module")
def users(spark):
    return fx.users(spark, SF_DIR)


@pytest.fixture
def table(spark, posts, tmp_path):
    path = str(tmp_path / "posts")
    rewrite.write_ranges(posts, path, SIZE)
    return path


def files(path):
    return {str(p): hashlib.md5(p.read_bytes()).hexdigest() for p in Path(path).rglob("*.parquet")}


def in_range(found, number):
    return {name for name in found if f"/range={number}/" in name}


EDIT = "event_id long, ts string, post_id long, actor_id long, title string, body string, op string"


def batch(spark, rows):
    return spark.createDataFrame(rows, EDIT).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def author(posts, post_id):
    return posts.filter(F.col("id") == post_id).first()["author_id"]


def test_only_touched_ranges_are_written(spark, posts, users, table):
    before = files(table)
    a, b = author(posts, 5), author(posts, 305)
    rows = [
        (1, "2030-01-01", 5, a, "new", "text", "update"),
        (2, "2030-01-01", 305, b, None, None, "delete"),
        (3, "2030-01-01", 410, b + 1, "not mine", "", "update"),
        (4, "2030-01-01", 505, author(posts, 505), "", "no title", "update"),
        (5, "2030-01-01", 99_999_999, a, "no post", "", "update"),
        (6, "2030-01-01", None, a, "no id", "", "update"),
    ]
    if author(posts, 410) == b + 1:
        rows[2] = (*rows[2][:3], b + 2, *rows[2][4:])
    change = batch(spark, rows)
    assert rewrite.rewrite_posts(spark, table, change, users, size=SIZE) == [0, 3]
    after = files(table)
    for number in range(16):
        same = in_range(before, number) == in_range(after, number)
        assert same == (number not in (0, 3)), number
    assert all(after[name] == before[name] for name in before.keys() & after.keys())
    left = rewrite.read_ranges(spark, table).drop("range")
    assert spark_rows(left) == spark_rows(edits.posts_after(posts, change, users))


def test_new_posts_and_emptied_ranges(spark, posts, users, table):
    gone = posts.filter("id between 700 and 799").select(
        F.col("id").alias("event_id"), F.lit("2030-01-01").alias("ts"), F.col("id").alias("post_id"),
        F.col("author_id").alias("actor_id"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("body"), F.lit("delete").alias("op"),
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    creates = fx.creates(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    expected = edits.posts_after(posts, gone, users, creates)
    touched = rewrite.rewrite_posts(spark, table, gone, users, creates, size=SIZE)
    largest = posts.agg(F.max("id")).first()[0]
    assert 7 in touched and set(touched) - {7} == set(range((largest + 1) // SIZE, expected.agg(F.max("id")).first()[0] // SIZE + 1))
    assert not Path(table, "range=7").exists()
    assert spark_rows(rewrite.read_ranges(spark, table).drop("range")) == spark_rows(expected)
    # Run again, as after a failure that was noticed late: the deletions change nothing more.
    assert rewrite.rewrite_posts(spark, table, gone, users, size=SIZE) == []


def test_a_batch_that_fails_leaves_the_table(spark, posts, users, table):
    before = files(table)
    broken = batch(spark, [(1, "2030-01-01", 5, author(posts, 5), "new", "text", "update")]).withColumn(
        "body", F.when(F.col("event_id") == 1, F.raise_error(F.lit("broken"))).otherwise(F.col("body"))
    )
    with pytest.raises(PySparkException, match="broken"):
        rewrite.rewrite_posts(spark, table, broken, users, size=SIZE)
    assert files(table) == before
    assert spark_rows(rewrite.read_ranges(spark, table).drop("range")) == spark_rows(posts)


def test_nothing_to_do(spark, posts, users, table):
    before = files(table)
    assert rewrite.rewrite_posts(spark, table, batch(spark, []), users, size=SIZE) == []
    assert files(table) == before


def test_deleted_ids_are_not_used_again(spark, posts, users, table):
    largest = posts.agg(F.max("id")).first()[0]
    last = batch(spark, [(1, "2030-01-01", largest, author(posts, largest), None, None, "delete")])
    rewrite.rewrite_posts(spark, table, last, users, size=SIZE)
    creates = fx.creates(spark.read.parquet(f"{SF_DIR}/events.parquet")).limit(1)
    rewrite.rewrite_posts(spark, table, batch(spark, []), users, creates, SIZE, largest_id=largest)
    assert rewrite.read_ranges(spark, table).agg(F.max("id")).first()[0] == largest + 1
