"""Every query against its SQL twin."""

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as entry_points
from inkwell.plans import catalog, oracles

SF_DIR = "/root/testdata/sf0.01"
QUERIES = catalog.QUERIES
ORACLES = oracles.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry_points_have_all_queries():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == sql_rows(con, ORACLES[name])


def test_entry(spark):
    feed = entry_points.entry(spark)
    assert feed.columns == ["id", "title", "body", "created", "author_id", "username"]
    assert feed.count() == 1500


# Counts worked out beforehand for sf0.01.
def _counts(df):
    return {row["outcome"]: row["n"] for row in df.collect()}


def test_login_counts(spark):
    assert _counts(QUERIES["login_counts"](spark, SF_DIR)) == {
        "ok": 6857,
        "Incorrect password.": 1714,
        "Incorrect username.": 1429,
    }


def test_upload_counts(spark):
    assert _counts(QUERIES["upload_counts"](spark, SF_DIR)) == {
        "ok": 600,
        "file type not allowed": 200,
        "No selected file": 100,
        "No file part": 100,
    }


def test_edit_counts(spark):
    gated = QUERIES["edit_gate"](spark, SF_DIR)
    counts = {(r["op"], r["outcome"]): r["count"] for r in gated.groupBy("op", "outcome").count().collect()}
    assert counts == {
        ("update", "403"): 3416,
        ("update", "ok"): 2713,
        ("update", "404"): 1923,
        ("update", "login"): 1317,
        ("update", "Title is required."): 341,
        ("delete", "403"): 95,
        ("delete", "ok"): 106,
        ("delete", "404"): 40,
        ("delete", "login"): 49,
    }


def test_registration_counts(spark):
    counted = QUERIES["registration_counts"](spark, SF_DIR)
    assert {row["verdict"]: row["n"] for row in counted.collect()} == {
        "taken": 7873,
        "Username is required": 796,
        "Password is required": 729,
        "400": 527,
        "ok": 75,
    }


def test_route_counts(spark):
    matched = QUERIES["route_match"](spark, SF_DIR)
    assert {r["status"]: r["count"] for r in matched.groupBy("status").count().collect()} == {
        200: 4455,
        404: 3750,
        405: 1795,
    }


def test_notice_counts(spark):
    from pyspark.sql import functions as F

    events = spark.read.parquet(f"{SF_DIR}/events.parquet").select("event_id", "ts")
    delivered = QUERIES["notice_delivery"](spark, SF_DIR).join(events, "event_id")
    row = delivered.agg(
        F.count_if(F.col("delivered_at") == F.col("ts")).alias("same"),
        F.count_if(F.col("delivered_at") > F.col("ts")).alias("later"),
        F.count_if(F.col("delivered_at").isNull()).alias("never"),
    ).first()
    assert tuple(row) == (2014, 1224, 782)
