"""Consecutive ids for rows that are added to a table."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.sources.scratch import freeze

# monotonically_increasing_id keeps the row's place in its partition in the low 33 bits.
PLACE_BITS = 33


def dense_ids(rows: DataFrame, order: list[str], first: Column) -> DataFrame:
    """Add `id`, counting up from `first` in `order`.

    The rows are range-sorted over all tasks and written with their place; then only
    the row count of each partition, one number per task, is summed up in order.
    """
    placed = freeze(
        rows.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "ids"
    ).withColumn("part", F.shiftright("place", PLACE_BITS))
    starts = (
        placed.groupBy("part")
        .agg(F.count("*").alias("n"))
        .select(
            "part",
            F.coalesce(
                F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ).alias("start"),
        )
    )
    place = F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), "part")
        .withColumn("id", first + F.col("start") + place)
        .drop("part", "place", "start")
    )


def next_id(table: DataFrame, at_least: int = 0) -> Column:
    """One more than the largest id of `table`, or than `at_least` if it has no rows."""
    return F.coalesce(table.agg(F.max("id")).scalar(), F.lit(at_least)) + 1
