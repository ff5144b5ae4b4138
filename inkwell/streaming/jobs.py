"""The operators on submissions that keep arriving.

Edits, new posts and registrations go into a BatchTable: each micro-batch writes what it
contributes to a folder named after its id and rewrites nothing else, so a batch that is
replayed after a failure replaces its own folder and nothing counts twice; old batches are folded.
Who is logged in is kept by Spark as state per client. With `every`, such as "1 minute", a
job goes on until it is stopped; without, it handles what has arrived and ends.
"""

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from inkwell.operators.accounts import first_registrations
from inkwell.operators.edits import apply_effects, edit_effects, merge_effects, new_posts
from inkwell.operators.ids import dense_ids
from inkwell.operators.validate import required_fields
from inkwell.sources import folders
from inkwell.streaming.batches import FOLD_EVERY, BatchTable

ACCOUNTS = "id bigint, username string, password string, bucket int"
CREATED = "id bigint, author_id bigint, created timestamp_ntz, title string, body string"
EFFECTS = (
    "post_id bigint, actor_id bigint, "
    "last struct<ts: timestamp_ntz, event_id: bigint, title: string, body: string>, "
    "removed boolean"
)
BUCKETS = 1024
LAST_TURN = "ts timestamp_ntz, event_id long, k string, seen_ms long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _run(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(every)).start()


def _trigger(every: str | None) -> dict[str, object]:
    """A batch each time the interval has passed, or all there is and then the end."""
    return {"processingTime": every} if every else {"availableNow": True}


def stream_required_fields(
    stream: DataFrame,
    fields: Sequence[tuple[str, str]],
    out: str,
    checkpoint: str,
    last_wins: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Write every submission with its `error` as it arrives."""
    return (
        required_fields(stream, fields, last_wins)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def _accounts(spark: SparkSession, out: str, fold_every: int = FOLD_EVERY) -> BatchTable:
    return BatchTable(spark, f"{out}/accounts", ACCOUNTS, by=["bucket"], every=fold_every)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("username"), F.lit(buckets)).cast("int").alias("bucket")


def _names(spark: SparkSession, users: DataFrame, out: str, buckets: int) -> DataFrame:
    """The names of the accounts there were at first, one folder per bucket of names."""
    path = f"{out}/names-{buckets}"
    if not folders.is_complete(spark, path):
        names = users.select("username", _bucket(buckets))
        names.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    return spark.read.schema("username string, bucket int").parquet(path)


def names_taken(names: DataFrame, added: DataFrame, wanted: list[int]) -> DataFrame:
    """All names in some buckets; the folders of other buckets aren't read."""
    both = names.unionByName(added.select("username", "bucket"))
    return both.filter(F.col("bucket").isin(wanted)).select("username")


def stream_registrations(
    stream: DataFrame,
    users: DataFrame,
    out: str,
    checkpoint: str,
    seal: Callable[[Column, Column], Column],
    every: str | None = None,
    buckets: int = BUCKETS,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Add accounts as registrations arrive; the first valid one for a free name wins.

    Names lie in folders by the hash of the name, and a batch reads only those of the
    names it holds, so with more `buckets` than names in a batch most accounts are never
    read; a bucket is a folder, so a small table has use for few. `users` is the table at the first start, read once for its names and its largest id.
    Only accounts of earlier batches count as taken, so a replayed batch does not meet
    its own output.
    """
    spark = stream.sparkSession
    accounts = _accounts(spark, out, fold_every)
    names = _names(spark, users, out, buckets)
    if not folders.numbered(spark, f"{out}/accounts/last", "batch"):
        accounts.set_last(-1, users.agg(F.max("id")).first()[0] or 0)

    def register(batch: DataFrame, batch_id: int) -> None:
        wanted = batch.filter(F.col("username").isNotNull()).select(_bucket(buckets)).distinct().collect()
        taken = names_taken(names, accounts.rows(before=batch_id), [row["bucket"] for row in wanted])
        accepted = first_registrations(batch, taken, "password")
        last = accounts.last(batch_id, 0)
        added = dense_ids(accepted, ["ts", "event_id"], F.lit(last + 1))
        sealed = seal(F.col("id"), F.col("password")).alias("password")
        rows = added.select("id", "username", sealed, _bucket(buckets))
        accounts.write(rows.repartition("bucket"), batch_id)
        accounts.set_last(batch_id, last + accounts.written(batch_id).count())

    return _run(stream, register, checkpoint, every)


def registered_users(spark: SparkSession, users: DataFrame, out: str) -> DataFrame:
    """All accounts so far."""
    return users.unionByName(_accounts(spark, out).rows().drop("bucket"))


def _effects(spark: SparkSession, out: str, fold_every: int = FOLD_EVERY) -> BatchTable:
    return BatchTable(spark, out, EFFECTS, merge_effects, every=fold_every)


def stream_apply_edits(
    stream: DataFrame, out: str, checkpoint: str, every: str | None = None, fold_every: int = FOLD_EVERY
) -> StreamingQuery:
    """Keep the effects of arriving edits; current_posts applies them."""
    effects = _effects(stream.sparkSession, out, fold_every)
    return _run(stream, lambda batch, number: effects.write(edit_effects(batch), number), checkpoint, every)


def _created(spark: SparkSession, out: str, fold_every: int = FOLD_EVERY) -> BatchTable:
    return BatchTable(spark, out, CREATED, every=fold_every)


def stream_create_posts(
    stream: DataFrame,
    posts: DataFrame,
    users: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None = None,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Add new posts as they arrive, with ids that go on from batch to batch.

    `posts` is the table at the first start, read once for its largest id.
    """
    created = _created(stream.sparkSession, out, fold_every)
    if not folders.numbered(stream.sparkSession, f"{out}/last", "batch"):
        created.set_last(-1, posts.agg(F.max("id")).first()[0] or 0)

    def add(batch: DataFrame, batch_id: int) -> None:
        last = created.last(batch_id, 0)
        created.write(new_posts(batch, users, F.lit(last + 1)), batch_id)
        created.set_last(batch_id, last + created.written(batch_id).count())

    return _run(stream, add, checkpoint, every)


def created_posts(spark: SparkSession, posts: DataFrame, out: str) -> DataFrame:
    """`posts` and those that stream_create_posts has added so far."""
    return posts.unionByName(_created(spark, out).rows())


def current_posts(
    spark: SparkSession, posts: DataFrame, users: DataFrame, out: str
) -> DataFrame:
    """`posts`, such as created_posts, as the edits so far have left them."""
    return apply_effects(posts, merge_effects(_effects(spark, out).rows()), users)


def _last_turn(client: tuple, chunks: Iterator[pd.DataFrame], state: GroupState, kept_ms: int | None) -> None:
    """Fold a client's requests, some at a time, into its last login or logout."""
    if state.hasTimedOut:
        state.remove()
        return
    ts, event_id, kind, seen = state.get if state.exists else (None, None, None, 0)
    for chunk in chunks:
        seen = max(seen, int(chunk["ms"].max()))
        turns = chunk[chunk["k"].isin(["login", "logout"])]
        if len(turns):
            newest = turns[turns["ts"] == turns["ts"].max()].nlargest(1, "event_id").iloc[0]
            found = (newest["ts"].to_pydatetime(), int(newest["event_id"]))
            if ts is None or found > (ts, event_id):
                ts, event_id, kind = *found, newest["k"]
    if ts is None:
        return
    state.update((ts, event_id, kind, seen))
    if kept_ms is not None:
        # A client whose time had run out before this batch ends with the next one.
        state.setTimeoutTimestamp(max(seen + kept_ms, state.getCurrentWatermarkMs() + 1))


def stream_sessions(
    stream: DataFrame,
    checkpoint: str,
    every: str | None = None,
    abandoned_after: str | None = None,
    late: str = "1 hour",
) -> StreamingQuery:
    """Keep each client's last login or logout as state; current_sessions reads who is logged in.

    The state lies in RocksDB under the checkpoint, one entry per client. With
    `abandoned_after`, such as "30 days", a client of whom nothing was seen for that long is
    forgotten, and rows that come more than `late` behind the newest are not looked at.
    Without, rows may come in any order and at any time.
    """
    spark = stream.sparkSession
    known = stream.filter(F.col("client_id").isNotNull()).select(
        "client_id", "event_id", "ts", "k", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        F.col("ts").cast("timestamp").alias("at"),
    )
    kept_ms, timeout = None, GroupStateTimeout.NoTimeout
    if abandoned_after is None:
        known = known.filter(F.col("k").isin("login", "logout"))
    else:
        known, timeout = known.withWatermark("at", late), GroupStateTimeout.EventTimeTimeout
        kept_ms = int(pd.Timedelta(abandoned_after).total_seconds() * 1000)

    def fold(client: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        _last_turn(client, chunks, state, kept_ms)
        yield pd.DataFrame({"client_id": pd.Series([], dtype=str)})

    folded = known.groupBy("client_id").applyInPandasWithState(fold, "client_id string", LAST_TURN, "update", timeout)
    # A stream keeps the settings it was started with.
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        writer = folded.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
        return writer.trigger(**_trigger(every)).start()
    finally:
        spark.conf.set(name, before)


def current_sessions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The known clients that are logged in, and since when, from the state of stream_sessions."""
    state = spark.read.format("statestore").load(checkpoint).select("key.client_id", "value.groupState.*")
    return state.filter(F.col("k") == "login").select("client_id", F.col("ts").alias("since"))
