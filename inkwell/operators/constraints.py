"""Rules of a stored table that parquet does not enforce: columns without NULL or repeats."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def constraint_checks(
    table: DataFrame, required: Sequence[str], unique: Sequence[str]
) -> DataFrame:
    """One row per rule: `rule` ('required' or 'unique'), `column`, and `n`, the rows that break it.

    A NULL in a required column breaks the rule; of rows that share a value of a unique one all
    but one do, and NULLs there repeat nothing. A rule that holds, as in an empty table, has 0.
    """
    nulls = table.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in required])
    entries = [
        F.struct(
            F.lit("required").alias("rule"), F.lit(name).alias("column"), F.col(name).alias("n")
        )
        for name in required
    ]
    checks = [nulls.select(F.inline(F.array(*entries)))] if required else []
    for name in unique:
        sizes = table.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
        checks.append(
            sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).select(
                F.lit("unique").alias("rule"), F.lit(name).alias("column"), "n"
            )
        )
    return reduce(DataFrame.unionByName, checks)
