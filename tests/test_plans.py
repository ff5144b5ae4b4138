"""What the plans must and must not contain, with automatic broadcasts switched off."""

import re

import pytest

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
IN_PYTHON = {"clean_filename", "store_uploads", "verify_password", "login_audit_hashed"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(df):
    return re.findall(r"ReadSchema: struct<(.*?)>", plan(df))


@pytest.fixture
def no_broadcast(conf):
    conf(autoBroadcastJoinThreshold="-1")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_join_and_no_needless_python(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert ("EvalPython" in text) == (name in IN_PYTHON)


def test_count_reads_one_column(spark):
    assert read_schemas(QUERIES["post_count"](spark, SF_DIR)) == ["o_orderkey:bigint"]


def test_orphans_read_the_owner_only(spark):
    assert "o_orderstatus" not in plan(QUERIES["orphan_posts"](spark, SF_DIR))


def test_page_reads_bodies_only_of_recent_posts(spark, no_broadcast):
    text = plan(QUERIES["feed_page"](spark, SF_DIR))
    wide = [line for line in text.splitlines() if "FileScan" in line and "o_orderstatus" in line]
    assert wide and all("GreaterThanOrEqual(o_orderdate,ScalarSubquery" in line for line in wide)


def test_page_is_chosen_by_narrow_columns_when_it_is_run(spark, no_broadcast):
    from inkwell.operators import content
    from inkwell.plans import fixtures as fx

    tracker = spark.sparkContext.statusTracker()
    posts, users = fx.posts(spark, SF_DIR), fx.users(spark, SF_DIR)
    spark.sparkContext.setJobGroup("page", "page")
    try:
        page = content.feed_page(posts, users, 25)
        assert not tracker.getJobIdsForGroup("page")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    narrow = [s for s in read_schemas(page) if "o_orderkey" in s and "o_orderpriority" not in s]
    assert narrow and "TakeOrderedAndProject" in plan(page)


def test_routes_need_no_shuffle(spark):
    assert "Exchange" not in plan(QUERIES["route_match"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["session_timeline", "notice_delivery"])
def test_one_shuffle_per_timeline(spark, no_broadcast, conf, name):
    """Only one exchange carries whole timelines, and only the sample and the summaries are broadcast."""
    conf(adaptive__enabled="false")
    text = plan(QUERIES[name](spark, SF_DIR))
    shuffled = [line for line in text.splitlines() if re.search(r"hashpartitioning\(client_id#\d+, alone#\d+L, piece", line)]
    assert len([line for line in shuffled if "ReusedExchange" not in line]) == 1
    assert "partial_min(struct(" in text


def test_first_registration_is_reduced_before_the_shuffle(spark, no_broadcast):
    assert "partial_min(struct" in plan(QUERIES["register_outcomes"](spark, SF_DIR))


def test_edits_are_reduced_before_the_shuffle(spark, no_broadcast):
    assert "partial_max" in plan(QUERIES["posts_after"](spark, SF_DIR))


def test_filter_on_a_key_reaches_the_scan(spark):
    from inkwell.plans import fixtures as fx

    assert "EqualTo(o_orderkey,7)" in plan(fx.posts(spark, SF_DIR).filter("id = 7"))
