"""Hot keys: same rows as the one-at-a-time replay, and no task that holds a hot group."""

import pytest
import replay
from pyspark.sql import functions as F

from inkwell.operators import accounts, content, edits, sessions, skew
from inkwell.plans import fixtures as fx
from inkwell.sources.scratch import freeze

SF_DIR = "/root/testdata/sf0.01"
PIECES = 100


@pytest.fixture(scope="module")
def events(spark):
    """The given events with two thirds of them on two clients, and some simultaneous ones."""
    hot = "case when event_id % 3 = 0 then 7 when event_id % 3 = 1 then 8 else user_id end"
    return (
        spark.read.parquet(f"{SF_DIR}/events.parquet")
        .withColumn("user_id", F.expr(f"cast({hot} as bigint)"))
        .withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
        .repartition(8)
    )


@pytest.fixture(scope="module")
def posts(spark):
    return fx.posts(spark, SF_DIR)


@pytest.fixture(scope="module")
def users_left(spark, posts):
    """The accounts without one in seven; the author of the hot post is among them."""
    author = posts.filter("id = 3").first()["author_id"]
    return fx.users(spark, SF_DIR).filter((F.col("id") % 7 != 0) | (F.col("id") == author))


@pytest.fixture(scope="module")
def hot_edits(events, posts):
    """Edits of which most go to one post, most of them by its author."""
    author = posts.filter("id = 3").first()["author_id"]
    on_one = F.col("event_id") % 5 != 0
    return (
        fx.edits(events, posts)
        .withColumn(
            "actor_id",
            F.when(on_one & (F.col("event_id") % 7 > 1), author).otherwise(F.col("actor_id")),
        )
        .withColumn("post_id", F.when(on_one, 3).otherwise(F.col("post_id")))
        .withColumn("post_id", F.when(F.col("event_id") % 13 > 0, F.col("post_id")))
    )


def tuples(df, *names):
    return [tuple(row) for row in df.select(*names).collect()]


ACT = ["event_id", "ts", "client_id", "k"]


def timeline(acts, pieces):
    rows = sessions.session_timeline(acts, pieces)
    return sorted(tuples(rows, "client_id", "seg", "started", "last_seen", "requests"), key=str)


def largest_part(df):
    """Share of the rows in the fullest partition."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    return max(sizes) / sum(sizes)


def test_cuts_split_a_timeline_evenly(events):
    cut = skew.cut_timelines(events, "user_id", ["ts", "event_id"], PIECES)
    pieces = cut.groupBy("user_id", "piece").count().collect()
    hot = [r["count"] for r in pieces if r["user_id"] in (7, 8)]
    assert 50 < len(hot) <= PIECES + 2 and max(hot) < 10 * 6667 / PIECES
    assert cut.count() == 10_000 and cut.columns == [*events.columns, "piece", "cut"]
    # Pieces follow each other in time.
    ends = cut.filter("user_id = 7").groupBy("piece").agg(F.min(F.struct("ts", "event_id")), F.max(F.struct("ts", "event_id")))
    ends = [(first, last) for _, first, last in sorted(ends.collect())]
    assert all(before[1] < after[0] for before, after in zip(ends, ends[1:]))


def test_cuts_are_the_same_whenever_worked_out(events):
    def picked(df):
        return sorted(map(tuple, skew._picked(df, "user_id", ["ts", "event_id"], PIECES).collect()))

    assert picked(events) == picked(events.repartition(3, "event_type")) and len(picked(events)) == PIECES
    nobody = events.select("event_id", F.lit(None).cast("long").alias("user_id"))
    assert skew._picked(nobody, "user_id", ["event_id"], PIECES).isEmpty()


def test_simultaneous_rows_are_cut_by_their_id(events):
    at_once = events.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    acts = fx.session_acts(at_once)
    cut = skew.cut_timelines(acts, "client_id", ["ts", "event_id"], PIECES)
    assert max(r["count"] for r in cut.groupBy("client_id", "piece").count().collect()) < 10 * 6667 / PIECES
    assert timeline(acts, PIECES) == replay.sessions(tuples(acts, *ACT))


@pytest.mark.parametrize("pieces", [1, 7, PIECES, 1000])
def test_sessions_of_hot_clients(events, pieces):
    acts = fx.session_acts(events)
    assert timeline(acts, pieces) == replay.sessions(tuples(acts, *ACT))


@pytest.mark.parametrize("pieces", [1, 7, PIECES, 1000])
def test_messages_of_hot_clients(events, pieces):
    acts = fx.notice_acts(events)
    got = dict(tuples(sessions.notice_delivery(acts, pieces), "event_id", "delivered_at"))
    assert got == replay.notices(tuples(acts, *ACT))


def one_client(spark, kinds):
    """Requests of one client, a second apart, of the kinds given by position; others are `request`."""
    cases = " ".join(f"when {i} then '{k}'" for i, k in kinds.items())
    return spark.range(3000).selectExpr(
        "id as event_id",
        "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as ts",
        "'only' as client_id",
        f"case id {cases} else 'request' end as k",
    )


def test_a_session_goes_on_over_pieces_without_a_turn(spark):
    acts = one_client(spark, {10: "login", 2990: "logout", 2995: "login"})
    assert timeline(acts, 300) == replay.sessions(tuples(acts, *ACT))
    open_end = one_client(spark, {2: "logout", 10: "login"})
    assert timeline(open_end, 300) == replay.sessions(tuples(open_end, *ACT))


def test_a_hot_client_is_spread_over_tasks(events, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    one = fx.session_acts(events).withColumn("client_id", F.lit("only"))
    turns = one.withColumn("k", F.when(F.col("event_id") % 2 == 0, "login").otherwise("logout"))
    assert largest_part(sessions.session_timeline(turns, 1)) > 0.9
    assert largest_part(sessions.session_timeline(turns, 1000)) < 0.25


def test_nothing_runs_when_called(spark, events, posts, users_left, hot_edits):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("called", "called")
    try:
        sessions.session_timeline(fx.session_acts(events))
        sessions.notice_delivery(fx.notice_acts(events))
        edits.edit_gate(hot_edits, posts, users_left)
        content.owned_posts(posts, spark.range(9).withColumnRenamed("id", "viewer_id"))
        assert not tracker.getJobIdsForGroup("called")
        events.count()
        assert tracker.getJobIdsForGroup("called")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_messages_wait_for_a_far_page(spark):
    """Pieces without any page in between pass the wait on."""
    events = spark.range(3000).selectExpr(
        "id as event_id",
        "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as ts",
        "id % 2 as client_id",
        "case when id = 2990 then 'view' when id = 2991 then 'clear' else 'flash_redirect' end as k",
    )
    got = dict(tuples(sessions.notice_delivery(events, PIECES), "event_id", "delivered_at"))
    assert got == replay.notices(tuples(events, *ACT))


EDIT = ["event_id", "ts", "post_id", "actor_id", "title", "body", "op"]


@pytest.mark.parametrize("pieces", [1, PIECES])
def test_edits_of_a_hot_post(hot_edits, posts, users_left, pieces):
    stored = {r["id"]: (r["author_id"], r["title"], r["body"]) for r in posts.collect()}
    verdicts, remaining = replay.edits(
        tuples(hot_edits, *EDIT), stored, {r["id"] for r in users_left.collect()}
    )
    gated = edits.edit_gate(hot_edits, posts, users_left, pieces)
    assert dict(tuples(gated, "event_id", "outcome")) == verdicts
    step_by_step = edits.apply_deletes(edits.apply_updates(posts, gated), gated)
    at_once = edits.posts_after(posts, hot_edits, users_left)
    for table in (step_by_step, at_once):
        rows = {r["id"]: (r["author_id"], r["title"], r["body"]) for r in table.collect()}
        assert rows == remaining


def test_hot_post_is_dealt_over_tasks(hot_edits, posts, users_left, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    assert largest_part(edits.edit_gate(hot_edits, posts, users_left, 1)) > 0.6
    assert largest_part(edits.edit_gate(hot_edits, posts, users_left, PIECES)) < 0.2


def test_edits_without_a_post_are_dealt_over_tasks(hot_edits, posts, users_left, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    lost = hot_edits.withColumn("post_id", F.expr("case when event_id % 3 = 0 then post_id end"))
    assert largest_part(edits.edit_gate(lost.filter("post_id is null"), posts, users_left, PIECES)) < 0.2


def test_hot_name(events, spark):
    users = fx.users(spark, SF_DIR)
    regs = fx.regs(events).withColumn(
        "username", F.when(F.col("event_id") % 3 > 0, "everybody").otherwise(F.col("username"))
    )
    taken = [r["username"] for r in users.collect()]
    rows = tuples(regs, "event_id", "ts", "username", "password")
    got = dict(tuples(accounts.register_outcomes(regs, users), "event_id", "outcome"))
    assert got == replay.registrations(rows, taken)


def test_posts_of_a_hot_author(spark, posts, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    hot_posts = posts.withColumn("author_id", F.expr("case when id % 3 > 0 then 5 else author_id end"))
    viewers = spark.range(2000).select(F.expr("id % 1000").alias("viewer_id"))
    whole = content.owned_posts(hot_posts, viewers, 1)
    dealt = content.owned_posts(hot_posts, viewers, PIECES)
    assert largest_part(whole) > 0.6 and largest_part(dealt) < 0.2
    expected = hot_posts.filter("author_id < 1000").select("id", "author_id")
    assert sorted(dealt.select("id", "viewer_id").collect()) == sorted(expected.collect())


@pytest.mark.parametrize("lookup", ["feed", "login", "orphans", "session", "cascade", "prefill"])
def test_hot_lookups_are_split_by_aqe(spark, events, hot_edits, posts, conf, lookup):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="2KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__coalescePartitions__enabled="false",
        files__maxPartitionBytes="32KB",
        files__openCostInBytes="0",
    )
    users = fx.users(spark, SF_DIR)
    hot_author = F.when(F.col("id") % 2 > 0, 5).otherwise(F.col("author_id"))
    hot_posts = freeze(posts.withColumn("author_id", hot_author).repartition(8), "hot")
    df = {
        "feed": lambda: content.feed(hot_posts, users),
        "login": lambda: accounts.login_audit(fx.logins(events), users, fx.sealed_match),
        "orphans": lambda: content.orphan_posts(hot_posts, users),
        "session": lambda: accounts.current_user(fx.sessions(events), users),
        "cascade": lambda: edits.cascade_delete(hot_posts, fx.removed_users(spark, SF_DIR)),
        "prefill": lambda: content.edit_prefill(hot_edits, posts),
    }[lookup]()
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
