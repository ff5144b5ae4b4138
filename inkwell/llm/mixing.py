"""Mixing sources to target weights by hash-random order and distributed prefix sums.

Every document gets a hash-random key: that of its id, or of its text where it has none. All
documents are range-sorted by source and key, so that a source has as many ranges as its rows
fill, and written in that order. Their sizes are summed up in two steps: inside each range with a
window, and over the ranges' totals, of which there is one per task and source in it. Rows that
repeat id and text are told apart by where they were read, so that they fill several ranges too.
A source takes whole epochs of itself while its budget lasts, and then the documents in key order
up to the word where the budget ends.

One row per source (not per document) meets in one task to share out the targets.

Cases: NULL text has size 0; documents of size 0 take 0 words; NULL sources are one source,
ranked last; rows that repeat an id are separate documents, ordered by size and therefore with
the same result on each run, and so are rows without an id; an empty table gives an empty result.
Other columns are ignored.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import text_key, word_count
from inkwell.operators.ids import PLACE_BITS
from inkwell.sources.scratch import freeze

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Targets of sources, from (source, source_size): shares by weight of the sum of all sizes,
    none above `most` times its source; what is above goes to the others by weight."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long")
    )
    # Sources reach their limit in the order of size per weight. The limit binds a source if its
    # share of what the earlier ones leave is at least the limit.
    by_limit = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    later = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    limit = most * F.col("source_size")
    bound = (
        weighted.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("taken_before", F.coalesce(F.sum(limit).over(earlier), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(later))
        .withColumn(
            "bound",
            limit * F.col("weight_left") <= F.col("weight") * (F.col("total") - F.col("taken_before")),
        )
        .withColumn("bound_sum", F.coalesce(F.sum(F.when(F.col("bound"), limit)).over(everything), F.lit(0)))
        .withColumn("free_weight", F.sum(F.when(~F.col("bound"), F.col("weight"))).over(everything))
    )
    share = F.col("weight").cast("double") * (F.col("total") - F.col("bound_sum")) / F.col("free_weight")
    target = F.when(F.col("bound"), limit.cast("double")).otherwise(share)
    return bound.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    most: int = MOST_EPOCHS,
) -> DataFrame:
    """Words taken of every document: doc_id, source, size, source_size, target, taken."""
    doc_id = F.col(id_col)
    source = F.col(source_col)
    sized = freeze(
        docs.select(
            doc_id.alias("doc_id"),
            source.alias("source"),
            F.coalesce(source, F.lit("")).alias("name"),
            source.isNull().alias("unnamed"),
            word_count(F.col(text_col)).alias("size"),
            F.when(doc_id.isNull(), text_key(F.col(text_col))).alias("stand_in"),
        ),
        "sizes",
    )
    where = ["name", "unnamed"]
    chance = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit(":"), "stand_in"))
    keyed = sized.select(
        "doc_id",
        "source",
        *where,
        "size",
        F.md5(chance.cast("binary")).alias("key"),
        F.monotonically_increasing_id().alias("read_at"),
    )
    in_order = keyed.orderBy(*where, "key", "size", "read_at").drop("key", "read_at")
    placed = freeze(in_order.withColumn("place", F.monotonically_increasing_id()), "mix-order").withColumn(
        "range", F.shiftright("place", PLACE_BITS)
    )
    ranges = placed.groupBy(*where, "source", "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy(*where).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("range_start", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
    targets = source_targets(
        ranges.groupBy(*where, "source").agg(F.sum("range_size").alias("source_size")),
        weights,
        most,
    ).select(
        F.coalesce("source", F.lit("")).alias("name"),
        F.col("source").isNull().alias("unnamed"),
        "source_size",
        "target",
    )
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    plan = (
        ranges.select(*where, "range", "range_start")
        .join(targets, where)
        .withColumn("epochs", epochs.cast("long"))
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    )
    inside = (
        Window.partitionBy(*where, "range")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    start = F.col("range_start") + F.col("upto") - F.col("size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start))
    return (
        placed.withColumn("upto", F.sum("size").over(inside))
        .join(plan, [*where, "range"])
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + cut).cast("long").alias("taken"),
        )
    )
