"""What the order of a client's requests decides: sessions and one-time messages.

An activity row holds event_id, ts, client_id and k, the kind of request. A client is a
browser, whether or not anybody is logged in there; a row without one belongs to a client
of its own.

Both are prefix scans. Timelines are cut into pieces, so that a busy client is spread over as
many tasks as it needs; one shuffle brings a piece's rows together, and one sort there decides
everything but what depends on the client's other pieces. For that, each piece of a cut timeline
is summed up in one row (there are as many as cuts), the summaries before or after a piece are
merged in order, and the outcome is broadcast and applied. No part of it runs when called.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.skew import cut_timelines

ORDER = ["ts", "event_id"]


def _turn() -> Column:
    return F.col("k").isin("login", "logout").cast("long")


def _alone() -> Column:
    """Tells apart the rows without a client."""
    return F.when(F.col("client_id").isNull(), F.col("event_id"))


def _pieces(acts: DataFrame, pieces: int | None) -> DataFrame:
    return cut_timelines(acts, "client_id", ORDER, pieces).withColumn("alone", _alone())


PIECE = ["client_id", "alone", "piece"]


def session_timeline(acts: DataFrame, pieces: int | None = None) -> DataFrame:
    """One row per session: client_id, seg, started, last_seen, requests.

    Kind 'login' is a successful login: it opens a session and ends an earlier one.
    'logout' ends the session. `seg` counts logins and logouts up to the session.
    """
    stretches = _stretches(_pieces(acts, pieces))
    around = _around(stretches)
    # Null-safe and with the flag: nothing tells the two readers of the stretches apart before the shuffle,
    # so that it happens once.
    same = F.col("client_id").eqNullSafe(F.col("of_client")) & F.col("piece").eqNullSafe(F.col("of_piece"))
    goes_on = F.col("seg") == F.col("turns")
    return (
        stretches.filter("opened")
        .join(F.broadcast(around), same & F.col("cut"), "left")
        .select(
            "client_id",
            (F.col("seg") + F.coalesce("before", F.lit(0))).alias("seg"),
            "started",
            F.greatest("last_seen", F.when(goes_on, F.col("last_seen_later"))).alias("last_seen"),
            (F.col("requests") + F.coalesce(F.when(goes_on, F.col("requests_later")), F.lit(0))).alias("requests"),
        )
    )


def _stretches(acts: DataFrame) -> DataFrame:
    """The stretches between two turns in a piece, `seg` counting the turns in it; `opened` if a login
    starts one. Stretch 0 comes before any turn and goes on with what an earlier piece left."""
    so_far = Window.partitionBy(*PIECE).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        acts.withColumn("seg", F.sum(_turn()).over(so_far))
        .groupBy(*PIECE, "seg")
        .agg(
            F.min("ts").alias("started"),
            F.max("ts").alias("last_seen"),
            F.count_if(F.col("k") == "request").alias("requests"),
            F.bool_or(F.col("k") == "login").alias("opened"),
            F.bool_or("cut").alias("cut"),
        )
    )


def _around(stretches: DataFrame) -> DataFrame:
    """For each piece of a cut timeline: the turns `before` it and in it, and what later pieces add to
    its last stretch, which are their stretches 0 up to the first piece with a turn."""
    # By the columns that the rows lie together by already.
    summaries = stretches.filter("cut").groupBy(*PIECE).agg(
        F.max("seg").alias("turns"),
        F.max(F.when(F.col("seg") == 0, F.col("last_seen"))).alias("last_seen"),
        F.sum(F.when(F.col("seg") == 0, F.col("requests")).otherwise(0)).alias("requests"),
    )
    by_piece = Window.partitionBy("client_id").orderBy("piece")
    earlier = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    # Pieces up to and with the next one that has a turn are one run; it ends in that piece.
    run = Window.partitionBy("client_id", "run").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, 0)
    before = F.coalesce(F.sum("turns").over(earlier), F.lit(0))
    numbered = summaries.withColumn("before", before).withColumn(
        "run", F.coalesce(F.sum((F.col("turns") > 0).cast("int")).over(earlier), F.lit(0))
    )
    from_here = numbered.withColumn("from_last_seen", F.max("last_seen").over(run)).withColumn(
        "from_requests", F.sum("requests").over(run)
    )
    # What a piece's last stretch gets begins in the next piece, whose run it is whether or not it had a turn.
    return from_here.select(
        F.col("client_id").alias("of_client"),
        F.col("piece").alias("of_piece"),
        "before",
        "turns",
        F.lead("from_last_seen").over(by_piece).alias("last_seen_later"),
        F.lead("from_requests").over(by_piece).alias("requests_later"),
    )


def notice_delivery(acts: DataFrame, pieces: int | None = None) -> DataFrame:
    """When each message is shown: event_id and delivered_at, NULL if never.

    'flash_render' leaves a message and shows it at once, 'flash_redirect' leaves one
    for the client's next page; 'view' is such a page. 'clear' empties the session and
    with it the messages still waiting. Other kinds matter to no message.
    """
    shows = F.col("k").isin("view", "flash_render")
    point = F.when(
        shows | (F.col("k") == "clear"),
        F.struct("ts", "event_id", F.when(shows, F.col("ts")).alias("shown_at")),
    )
    relevant = acts.filter(F.col("k").isin("view", "flash_render", "flash_redirect", "clear"))
    cut = _pieces(relevant, pieces).withColumn("point", point)
    # Backwards in time, so that "the next one" is the last one met so far.
    from_here_on = (
        Window.partitionBy(*PIECE)
        .orderBy(*map(F.desc, ORDER))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    messages = cut.withColumn("next", F.last("point", ignorenulls=True).over(from_here_on)).filter(
        F.col("k").isin("flash_redirect", "flash_render")
    )
    return messages.join(F.broadcast(_points_after(cut)), ["client_id", "piece"], "left").select(
        "event_id", F.coalesce("next", "after")["shown_at"].alias("delivered_at")
    )


def _points_after(acts: DataFrame) -> DataFrame:
    """For each piece of a cut timeline the first point `after` it that shows or drops messages."""
    later = Window.partitionBy("client_id").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    return (
        acts.filter("cut")
        .groupBy("client_id", "piece")
        .agg(F.min("point").alias("first"))
        .select("client_id", "piece", F.last("first", ignorenulls=True).over(later).alias("after"))
    )
