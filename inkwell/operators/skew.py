"""Keeping hot keys apart: one post, client or name may hold a third of all rows.

A lookup in a stored table whose result is written out, or regrouped by another key, is
left to AQE, which splits a hot join partition by itself. The cases below are those it
leaves whole: a join next to a grouping by the same key, and an ordered window.

Both rest on one row picked from each of `pieces` hash cells: a uniform sample whose size does
not depend on the table's. It is reduced in every task before its shuffle, small enough to
broadcast, part of the plan (nothing runs when an operator is called), and decided by the rows
alone, so every part of a plan that refers to it sees the same. A key that holds a share of the
rows holds about that share of the sample and gets as many pieces.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECES_PER_TASK = 4


def piece_count(rows: DataFrame, pieces: int | None) -> int:
    """`pieces`, or a few for each task of a shuffle."""
    return pieces or PIECES_PER_TASK * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _picked(rows: DataFrame, key: str, columns: list[str], pieces: int) -> DataFrame:
    """At most `pieces` rows that have a key, with `key` and `columns`, picked by the hash of `columns`."""
    chance = F.xxhash64(*columns)
    # The smallest by hash and then by content: the same whenever it is worked out.
    return (
        rows.filter(F.col(key).isNotNull())
        .groupBy(F.pmod(chance, F.lit(pieces)).alias("cell"))
        .agg(F.min(F.struct(F.xxhash64(F.lit(7), *columns), *columns, key)).alias("row"))
        .select(*[F.col("row")[name].alias(name) for name in dict.fromkeys([key, *columns])])
    )


def spread_lookup(
    rows: DataFrame,
    keyed: DataFrame,
    key: str,
    row_id: str,
    pieces: int | None = None,
    searched: DataFrame | None = None,
) -> DataFrame:
    """`rows` left-joined to `keyed`, which has one row per `key`, without hot partitions.

    Rows of a hot key are dealt over several salts and its row in `keyed` is copied to
    each of them; rows without a key match nothing and are dealt freely. There are at most
    `pieces` copies besides the rows themselves. As the salt is part of the join key, a
    later grouping by `key` starts from reduced rows. The sample is taken from `searched`
    where that has the same keys and is cheaper to read; like `rows` it must be the same
    on every read.
    """
    n = piece_count(rows, pieces)
    source = rows if searched is None else searched
    salts = _picked(source, key, [row_id], n).groupBy(key).agg(F.count("*").cast("int").alias("salts"))

    def with_salts(df: DataFrame) -> DataFrame:
        found = df.join(F.broadcast(salts), key, "left")
        return found.withColumn("salts", F.when(F.col(key).isNull(), n).otherwise(F.coalesce("salts", F.lit(1))))

    dealt = with_salts(rows).withColumn("salt", F.pmod(F.xxhash64(row_id), "salts").cast("int")).drop("salts")
    each_salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    copies = with_salts(keyed).withColumn("salt", each_salt).drop("salts")
    return dealt.join(copies, [key, "salt"], "left").drop("salt")


def cut_timelines(rows: DataFrame, key: str, order: list[str], pieces: int | None = None) -> DataFrame:
    """`rows` with the `piece` 0, 1, 2, … of its key's timeline that each is in, and whether that is `cut` at all.

    The picked rows are where the timelines are cut, at most `pieces` cuts in all. Pieces
    are in the order of `order` and hold about equally many rows.
    """
    n = piece_count(rows, pieces)
    cuts = (
        _picked(rows, key, order, n)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias("cuts"))
    )
    found = rows.join(F.broadcast(cuts), key, "left")
    piece = _cuts_passed(F.col("cuts"), F.struct(*order), n).alias("piece")
    return found.select(*rows.columns, piece, F.col("cuts").isNotNull().alias("cut"))


def _cuts_passed(cuts: Column, at: Column, longest: int) -> Column:
    """How many of the sorted `cuts` are at or before `at`, by binary search."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(longest.bit_length()))])
    passed = F.aggregate(
        steps, F.lit(0), lambda n, step: n + F.when(F.get(cuts, n + step - 1) <= at, step).otherwise(0)
    )
    return F.when(cuts.isNull(), 0).otherwise(passed)
