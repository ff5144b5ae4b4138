"""Reading posts: the feed, lookups and checks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import byline
from inkwell.operators.skew import spread_lookup

FEED_COLUMNS = ["id", "title", "body", "created", "author_id", "username"]


def _authored(posts: DataFrame, users: DataFrame) -> DataFrame:
    authors = users.select(F.col("id").alias("author_id"), "username")
    return posts.join(authors, "author_id").select(*FEED_COLUMNS)


def feed(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Every post with its author's name, newest first."""
    return _authored(posts, users).orderBy(F.desc("created"), "id")


def feed_page(posts: DataFrame, users: DataFrame, n: int) -> DataFrame:
    """The first `n` rows of the feed.

    They are chosen by the narrow columns that decide, and titles and bodies are read only
    afterwards, for posts no older than the oldest one chosen.
    """
    authors = users.select(F.col("id").alias("author_id"), "username")
    newest_first = [F.desc("created"), "id"]
    chosen = posts.select("id", "author_id", "created").join(authors, "author_id").orderBy(*newest_first).limit(n)
    oldest = chosen.agg(F.min("created")).scalar()
    page = posts.filter(F.col("created") >= oldest).join(chosen.select("id", "username"), "id")
    return page.select(*FEED_COLUMNS).orderBy(*newest_first)


def feed_byline(feed: DataFrame) -> DataFrame:
    """Add the line that names author and day."""
    return feed.withColumn("byline", byline(F.col("username"), F.col("created")))


def post_by_id(posts: DataFrame, users: DataFrame, ids: DataFrame) -> DataFrame:
    """The wanted posts with their authors; a post whose author is missing is not found."""
    return _authored(posts.join(ids.select("id").distinct(), "id", "left_semi"), users)


def owned_posts(posts: DataFrame, viewers: DataFrame, pieces: int | None = None) -> DataFrame:
    """The posts a viewer may edit: those whose author is among `viewers`."""
    authors = viewers.select(F.col("viewer_id").alias("author_id"), "viewer_id").distinct()
    found = spread_lookup(posts, authors, "author_id", "id", pieces)
    return found.filter(F.col("viewer_id").isNotNull())


def orphan_posts(posts: DataFrame, users: DataFrame) -> DataFrame:
    """The posts whose author has no account."""
    return posts.join(users.select(F.col("id").alias("author_id")), "author_id", "left_anti")


def post_count(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count("id").alias("n"))


def edit_prefill(edits: DataFrame, posts: DataFrame) -> DataFrame:
    """What the edit form shows: the submitted text, or the stored one where that is empty."""
    stored = posts.select("id", F.col("title").alias("old_title"), F.col("body").alias("old_body"))

    def shown(field: str) -> Column:
        return F.coalesce(F.nullif(F.col(field), F.lit("")), F.col(f"old_{field}")).alias(field)

    return edits.join(stored, F.col("post_id") == F.col("id")).select(
        "event_id", "id", shown("title"), shown("body")
    )
