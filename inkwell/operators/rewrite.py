"""Changing a stored post table in place, only where a batch touches it.

The table lies in folders `range`=id div size, so that a batch of edits and new posts rewrites
the ranges of the posts it changes and leaves all other files alone.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from inkwell.operators.edits import apply_effects, edit_effects, new_posts
from inkwell.schemas import POSTS
from inkwell.sources import folders
from inkwell.sources.scratch import freeze

RANGE_SIZE = 1_000_000


def _range(size: int) -> Column:
    return F.expr(f"id div {size}").alias("range")


def write_ranges(posts: DataFrame, path: str, size: int = RANGE_SIZE) -> None:
    """Write a post table in id ranges."""
    _in_ranges(posts, size).write.partitionBy("range").parquet(path)


def _in_ranges(posts: DataFrame, size: int) -> DataFrame:
    return posts.select(*POSTS.fieldNames(), _range(size)).repartitionByRange("range", "id").sortWithinPartitions("range", "id")


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The table, with `range`; a filter on `range` skips folders."""
    return spark.read.schema(StructType([*POSTS.fields, StructField("range", LongType())])).parquet(path)


def _numbers(rows: DataFrame) -> list[int]:
    """The ranges in `rows`, of which there are at most as many as folders in the table."""
    return sorted(row["range"] for row in rows.select("range").distinct().collect())


def rewrite_posts(
    spark: SparkSession,
    path: str,
    edits: DataFrame,
    users: DataFrame,
    creates: DataFrame | None = None,
    size: int = RANGE_SIZE,
    largest_id: int | None = None,
) -> list[int]:
    """Bring the table at `path` up to date with a batch: the same rows as posts_after. Gives the
    ranges that were written.

    A range is touched by a new post in it, or by an update or a deletion by the post's own
    author; in the ranges that other rows aim at only ids and authors are read. New posts are
    numbered after `largest_id`, for tables whose last post may have been deleted, or else
    after the largest id in the table.

    What takes the place of a range is complete beside the table before any file is replaced, so a
    batch that fails leaves the table as it was and can be run again. Ranges all of whose
    posts are deleted are removed last. Nobody else may write to the table meanwhile.
    """
    effects = freeze(edit_effects(edits).withColumn("range", F.expr(f"post_id div {size}")), "effects")
    table, stored = read_ranges(spark, path), folders.numbered(spark, path, "range")
    real = effects.filter("last is not null or removed").filter(F.col("range").isin(stored))
    own = real.select(F.col("post_id").alias("id"), F.col("actor_id").alias("author_id"))
    accounts = users.select(F.col("id").alias("author_id"))
    aimed = table.filter(F.col("range").isin(_numbers(real))).join(own, ["id", "author_id"], "left_semi")
    touched = _numbers(aimed.join(accounts, "author_id", "left_semi"))
    added = None
    if creates is not None:
        if largest_id is None:
            largest_id = table.filter(F.col("range").isin(stored[-1:])).agg(F.max("id")).first()[0] or 0
        added = freeze(new_posts(creates, users, F.lit(largest_id + 1)), "added")
        touched = sorted({*touched, *_numbers(added.withColumn("range", _range(size)))})
    kept = apply_effects(table.filter(F.col("range").isin(touched)).drop("range"), effects.drop("range"), users)
    changed = freeze(_in_ranges(kept if added is None else kept.unionByName(added), size), "ranges")
    in_place = changed.repartitionByRange("range", "id").sortWithinPartitions("range", "id").write.mode("overwrite")
    in_place.option("partitionOverwriteMode", "dynamic").partitionBy("range").parquet(path)
    for emptied in set(touched) - set(_numbers(changed)):
        folders.remove(spark, f"{path}/range={emptied}")
    return touched
