"""Streams over several micro-batches give what the batch operators give."""

import re

import duckdb
import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from inkwell.operators import accounts, edits, validate
from inkwell.plans import fixtures as fx
from inkwell.sources.submissions import delivered_once, submission_stream
from inkwell.streaming import jobs
from inkwell.streaming.batches import BatchTable

SF_DIR = "/root/testdata/sf0.01"
BATCHES = 4


@pytest.fixture(scope="module")
def arriving(tmp_path_factory):
    """The given events as one file per batch, oldest first."""
    folder = tmp_path_factory.mktemp("arriving")
    for i in range(BATCHES):
        duckdb.execute(
            f"copy (select * from '{SF_DIR}/events.parquet' where event_id // 2500 = {i}) "
            f"to '{folder}/events-{i}.parquet'"
        )
    return str(folder)


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


@pytest.fixture
def stream(spark, arriving, events):
    return submission_stream(spark, f"{arriving}/events-*.parquet", events.schema, 1)


def run_with_replay(start, checkpoint):
    """Run to the end, then once more as if the last batch had failed before its commit."""
    start().awaitTermination()
    commits = sorted(p.name for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    assert commits == [str(i) for i in range(BATCHES)]
    for name in (commits[-1], f".{commits[-1]}.crc"):
        (checkpoint / "commits" / name).unlink()
    start().awaitTermination()


def test_required_fields(spark, stream, events, tmp_path):
    fields = validate.REGISTRATION_FIELDS
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    jobs.stream_required_fields(
        fx.regs(stream), fields, out, checkpoint, last_wins=True
    ).awaitTermination()
    expected = validate.required_fields(fx.regs(events), fields, last_wins=True)
    assert spark_rows(spark.read.parquet(out)) == spark_rows(expected)


@pytest.mark.parametrize("fold_every", [1, 2, 50])
def test_registrations(spark, stream, events, tmp_path, fold_every):
    users = fx.users(spark, SF_DIR)
    out, checkpoint = str(tmp_path / "out"), tmp_path / "checkpoint"
    run_with_replay(
        lambda: jobs.stream_registrations(
            fx.regs(stream), users, out, str(checkpoint), fx.seal, buckets=16, fold_every=fold_every
        ),
        checkpoint,
    )
    expected = accounts.register_users(users, fx.regs(events), fx.seal)
    assert spark_rows(jobs.registered_users(spark, users, out)) == spark_rows(expected)


def test_only_the_buckets_of_a_batch_are_read(spark, tmp_path):
    users, out = fx.users(spark, SF_DIR), str(tmp_path)
    names = jobs._names(spark, users, out, 64)
    accounts = jobs._accounts(spark, out)
    rows = [(9000 + i, f"New#{i}", "p") for i in range(50)]
    added = spark.createDataFrame(rows, "id long, username string, password string")
    accounts.write(added.select("*", jobs._bucket(64)), 0)
    taken = jobs.names_taken(names, accounts.rows(), [3, 40])
    plan = taken._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert all(re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(3,40\)", line) for line in scans)
    both = users.select("username").unionByName(added.select("username"))
    expected = both.filter(jobs._bucket(64).isin(3, 40))
    assert spark_rows(taken) == spark_rows(expected) and 0 < taken.count() < 100


@pytest.mark.parametrize("fold_every", [1, 2, 50])
def test_edits(spark, stream, events, tmp_path, fold_every):
    posts, users = fx.posts(spark, SF_DIR), fx.kept_users(spark, SF_DIR)
    out, checkpoint = str(tmp_path / "out"), tmp_path / "checkpoint"
    run_with_replay(
        lambda: jobs.stream_apply_edits(
            fx.edits(stream, posts), out, str(checkpoint), fold_every=fold_every
        ),
        checkpoint,
    )
    batches = [p.name for p in (tmp_path / "out" / "batches").iterdir()]
    assert len(batches) <= 2 * fold_every + 1 and len(batches) == {1: 2, 2: 4, 50: 4}[fold_every]
    expected = edits.posts_after(posts, fx.edits(events, posts), users)
    assert spark_rows(jobs.current_posts(spark, posts, users, out)) == spark_rows(expected)


def test_new_posts(spark, stream, events, tmp_path):
    posts, users = fx.posts(spark, SF_DIR), fx.kept_users(spark, SF_DIR)
    out, checkpoint = str(tmp_path / "out"), tmp_path / "checkpoint"
    run_with_replay(
        lambda: jobs.stream_create_posts(
            fx.creates(stream), posts, users, out, str(checkpoint), fold_every=2
        ),
        checkpoint,
    )
    created = jobs.created_posts(spark, posts, out)
    expected = edits.create_posts(posts, fx.creates(events), users)
    assert spark_rows(created) == spark_rows(expected)
    # Edits reach posts that were created before.
    author = created.filter("id = 15000").first()["author_id"]
    change = spark.createDataFrame(
        [(1, "2030-01-01", 15000, author, "new", "text", "update")],
        "event_id long, ts string, post_id long, actor_id long, title string, body string, op string",
    ).selectExpr("* except (ts)", "cast(ts as timestamp_ntz) as ts")
    after = edits.posts_after(created, change, users)
    assert after.filter("id = 15000").first()["title"] == "new"


def last_logins(acts):
    """Who is logged in after all requests, one by one."""
    last = {}
    for _, ts, client, kind in sorted(acts, key=lambda r: (r[1], r[0])):
        if client is not None and kind in ("login", "logout"):
            last[client] = (kind, ts)
    return {client: ts for client, (kind, ts) in last.items() if kind == "login"}


def logged_in(spark, checkpoint):
    return {r["client_id"]: r["since"] for r in jobs.current_sessions(spark, str(checkpoint)).collect()}


def test_sessions(spark, stream, events, tmp_path):
    checkpoint = tmp_path / "checkpoint"
    run_with_replay(lambda: jobs.stream_sessions(fx.session_acts(stream), str(checkpoint)), checkpoint)
    assert logged_in(spark, checkpoint) == last_logins([tuple(r) for r in fx.session_acts(events).collect()])


def test_sessions_whose_rows_come_out_of_order(spark, events, tmp_path):
    """The newest quarter first; and a restart after each batch."""
    source, checkpoint = tmp_path / "in", tmp_path / "checkpoint"
    for i in (3, 0, 2, 1):
        events.filter(f"event_id div 2500 = {i}").coalesce(1).write.mode("append").parquet(str(source))
        stream = submission_stream(spark, str(source), events.schema)
        jobs.stream_sessions(fx.session_acts(stream), str(checkpoint)).awaitTermination()
    assert logged_in(spark, checkpoint) == last_logins([tuple(r) for r in fx.session_acts(events).collect()])


def test_abandoned_sessions_are_forgotten(spark, tmp_path):
    def arrive(*rows):
        acts = spark.createDataFrame(rows, "event_id long, ts string, client_id string, k string")
        acts = acts.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        acts.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = submission_stream(spark, str(tmp_path / "in"), acts.schema)
        checkpoint = str(tmp_path / "checkpoint")
        jobs.stream_sessions(stream, checkpoint, abandoned_after="2 days", late="1 hour").awaitTermination()
        return set(logged_in(spark, checkpoint))

    assert arrive((1, "2024-01-01", "a", "login"), (2, "2024-01-01", "b", "login"), (3, "2024-01-01", "c", "request")) == {"a", "b"}
    assert arrive((4, "2024-01-02 12:00:00", "b", "request")) == {"a", "b"}
    # Nothing was seen of a for more than two days; b's time counts from its last request.
    assert arrive((5, "2024-01-03 12:00:00", "c", "login")) == {"b", "c"}
    assert arrive((6, "2024-01-03 12:30:00", "c", "logout"), (7, "2024-01-01", "d", "login")) == {"b"}
    assert arrive((8, "2024-01-09", "e", "login")) == {"e"}


def test_a_submission_delivered_again_counts_once(spark, tmp_path):
    def arrive(*rows):
        acts = spark.createDataFrame(rows, "event_id long, ts string, text string")
        acts = acts.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        acts.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        once = delivered_once(submission_stream(spark, str(tmp_path / "in"), acts.schema), "1 hour")
        assert once.columns == acts.columns
        query = once.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "checkpoint")
        ).trigger(availableNow=True).start()
        query.awaitTermination()
        found = spark.read.schema(acts.schema).parquet(str(tmp_path / "out"))
        kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        return sorted(r.event_id for r in found.collect()), kept

    assert arrive((1, "2024-01-01 00:00:00", "a"), (2, "2024-01-01 00:10:00", "b"), (1, "2024-01-01 00:00:00", "a")) == ([1, 2], 2)
    assert arrive((2, "2024-01-01 00:10:00", "b"), (3, "2024-01-01 00:30:00", "c"), (1, "2024-01-01 00:00:00", "a"))[0] == [1, 2, 3]
    # Ids far behind the newest submission leave the state.
    found, kept = arrive((4, "2024-01-02 00:00:00", "d"))
    assert found == [1, 2, 3, 4] and kept == 1


def test_goes_on_until_stopped(spark, stream, events, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    query = jobs.stream_sessions(fx.session_acts(stream), checkpoint, every="0 seconds")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert jobs.current_sessions(spark, checkpoint).count() == 129


def test_nothing_has_arrived_yet(spark, tmp_path):
    posts = fx.posts(spark, SF_DIR)
    left = jobs.current_posts(spark, posts, fx.users(spark, SF_DIR), str(tmp_path / "effects"))
    assert left.count() == posts.count()


def test_folds_hold_what_batches_held(spark, tmp_path):
    """Whatever batch is read up to, before and after folds and a fold that was broken off."""
    table = BatchTable(spark, str(tmp_path), "k int, n int", lambda df: df.groupBy("k").agg(F.sum("n").cast("int").alias("n")), every=3)
    total = {}
    for batch in range(11):
        if batch == 7:
            (tmp_path / "folded" / "upto=6").mkdir(parents=True)
        rows = [(batch % 4, batch), (9, 1)]
        table.write(spark.createDataFrame(rows, "k int, n int"), batch)
        for k, n in rows:
            total[k] = total.get(k, 0) + n
        found = {r.k: r.n for r in table.rows().groupBy("k").agg(F.sum("n").alias("n")).collect()}
        assert found == total
        # A replay sees what was there before, and replaces its own.
        earlier = {r.k: r.n for r in table.rows(before=batch).groupBy("k").agg(F.sum("n").alias("n")).collect()}
        assert sum(earlier.values()) == sum(total.values()) - batch - 1
        table.write(spark.createDataFrame(rows, "k int, n int"), batch)
    assert table.folds() == [5, 8]
    assert sorted(int(p.name[6:]) for p in (tmp_path / "batches").iterdir()) == [6, 7, 8, 9, 10]
