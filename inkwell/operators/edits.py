"""Changes to the post table: new posts, edits, deletions.

An edit row holds event_id, ts, post_id, actor_id, title, body and op, which is
'update' or 'delete'. A change to a table is a new table.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import missing_post_message
from inkwell.operators.ids import dense_ids, next_id
from inkwell.operators.skew import spread_lookup
from inkwell.operators.validate import (
    BAD_REQUEST,
    LOGIN,
    OK,
    POST_FIELDS,
    TITLE_REQUIRED,
    any_absent,
    required_fields,
)
from inkwell.schemas import POSTS


def edit_gate(
    edits: DataFrame, posts: DataFrame, users: DataFrame, pieces: int | None = None
) -> DataFrame:
    """Add `outcome` and, for a missing post, `message` to every edit.

    An actor without an account is not logged in, and a post whose author has none is missing.
    From the author's first deletion on, a post is missing for everyone. Deletions are
    reduced per post and actor before they meet the posts, so that join has one row per
    key on both sides; only the lookup of the edits themselves can meet a hot post.
    """
    deletions = (
        edits.filter((F.col("op") == "delete") & F.col("actor_id").isNotNull())
        .groupBy("post_id", "actor_id")
        .agg(F.min(F.struct("ts", "event_id")).alias("deleted"))
        .withColumnRenamed("actor_id", "author_id")
    )
    state = (
        posts.select(F.col("id").alias("post_id"), "author_id")
        .join(users.select(F.col("id").alias("author_id")), "author_id", "left_semi")
        .join(deletions, ["post_id", "author_id"], "left")
        .withColumn("found", F.lit(True))
    )
    gone = F.col("found").isNull() | (F.struct("ts", "event_id") > F.col("deleted"))
    is_update = F.col("op") == "update"
    outcome = (
        F.when(F.col("known").isNull(), LOGIN)
        .when(gone, "404")
        .when(F.col("actor_id") != F.col("author_id"), "403")
        .when(is_update & any_absent("title", "body"), BAD_REQUEST)
        .when(is_update & (F.col("title") == ""), TITLE_REQUIRED)
        .otherwise(OK)
    )
    actors = users.select(F.col("id").alias("actor_id"), F.lit(True).alias("known"))
    by_actor = edits.join(actors, "actor_id", "left")
    return (
        spread_lookup(by_actor, state, "post_id", "event_id", pieces, searched=edits)
        .withColumn("outcome", outcome)
        .withColumn(
            "message", F.when(F.col("outcome") == "404", missing_post_message(F.col("post_id")))
        )
        .drop("author_id", "deleted", "found", "known")
    )


def apply_updates(posts: DataFrame, gated: DataFrame) -> DataFrame:
    """`posts` with title and body of the last accepted update of each."""
    last = (
        gated.filter((F.col("outcome") == OK) & (F.col("op") == "update"))
        .groupBy(F.col("post_id").alias("id"))
        .agg(F.max(F.struct("ts", "event_id", "title", "body")).alias("last"))
    )
    return _with_last(posts.join(last, "id", "left"))


def _with_last(posts: DataFrame) -> DataFrame:
    return posts.select(
        "id",
        "author_id",
        "created",
        F.coalesce("last.title", "title").alias("title"),
        F.coalesce("last.body", "body").alias("body"),
    )


def apply_deletes(posts: DataFrame, gated: DataFrame) -> DataFrame:
    """`posts` without those an accepted deletion names."""
    gone = gated.filter((F.col("outcome") == OK) & (F.col("op") == "delete"))
    return posts.join(gone.select(F.col("post_id").alias("id")).distinct(), "id", "left_anti")


def cascade_delete(posts: DataFrame, removed_users: DataFrame) -> DataFrame:
    """`posts` without those of the removed accounts."""
    gone = removed_users.select(F.col("id").alias("author_id"))
    return posts.join(gone, "author_id", "left_anti").select(*POSTS.fieldNames())


def new_posts(creates: DataFrame, users: DataFrame, first: Column) -> DataFrame:
    """The valid new posts, with ids counting up from `first`.

    A new post belongs to the session's user, who must have an account, and dates from its
    submission.
    """
    valid = required_fields(creates, POST_FIELDS).filter(
        F.col("error").isNull() & F.col("body").isNotNull()
    )
    owned = valid.join(users.select(F.col("id").alias("author_id")), "author_id", "left_semi")
    added = dense_ids(
        owned.select("event_id", "ts", "author_id", "title", "body"), ["ts", "event_id"], first
    )
    return added.select("id", "author_id", F.col("ts").alias("created"), "title", "body")


def create_posts(
    posts: DataFrame, creates: DataFrame, users: DataFrame, numbered: DataFrame | None = None
) -> DataFrame:
    """`posts` with the valid new ones added under the next free ids.

    Ids go on after the largest of `numbered` where deleted posts are no longer in `posts`.
    """
    first = next_id(posts if numbered is None else numbered)
    return posts.unionByName(new_posts(creates, users, first))


def edit_effects(edits: DataFrame) -> DataFrame:
    """Per post and actor: the last valid update and whether there is a deletion.

    This is all of a batch that the final table depends on. It shrinks before the
    shuffle, and effects of several batches merge with merge_effects.
    """
    valid_update = (F.col("op") == "update") & (F.col("title") != "") & F.col("body").isNotNull()
    return (
        edits.filter(F.col("actor_id").isNotNull())
        .groupBy("post_id", "actor_id")
        .agg(
            F.max(F.when(valid_update, F.struct("ts", "event_id", "title", "body"))).alias("last"),
            F.max(F.col("op") == "delete").alias("removed"),
        )
    )


def merge_effects(effects: DataFrame) -> DataFrame:
    return effects.groupBy("post_id", "actor_id").agg(
        F.max("last").alias("last"), F.max("removed").alias("removed")
    )


def apply_effects(posts: DataFrame, effects: DataFrame, users: DataFrame) -> DataFrame:
    """The post table once the effects of each post's own author, if in `users`, have taken place."""
    authors = users.select(F.col("id").alias("author_id"))
    own = effects.withColumnsRenamed({"post_id": "id", "actor_id": "author_id"}).join(
        authors, "author_id", "left_semi"
    )
    joined = posts.join(own, ["id", "author_id"], "left")
    return _with_last(joined.filter(~F.coalesce("removed", F.lit(False))))


def posts_after(
    posts: DataFrame, edits: DataFrame, users: DataFrame, creates: DataFrame | None = None
) -> DataFrame:
    """The post table after a batch of edits and new posts.

    Same rows as edit_gate, apply_updates and apply_deletes one after the other, but
    without a verdict per edit: an author's deletion outlives any update, so only the
    effects per post and actor meet the posts, and both sides have one row per key.
    """
    kept = apply_effects(posts, edit_effects(edits), users)
    return kept if creates is None else create_posts(kept, creates, users, numbered=posts)
