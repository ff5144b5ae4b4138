"""Labelled samples, fitting in one task, and scoring in Arrow batches, for the classifiers."""

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import held_out, text_key
from inkwell.sources.scratch import freeze

BINS = 1 << 12  # what a pass of `quantiles` tells apart


def hash_order(df: DataFrame, n: int) -> DataFrame:
    """`n` rows that are the same on every run: those whose id and text hash lowest."""
    order = F.xxhash64(F.col("doc_id").cast("string"), "key")
    return df.orderBy(order, "doc_id", "key").limit(n)


def labelled(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Documents of the learning folds with their label (0 or 1); NULL labels don't count, and
    of contradicting labels of an id the larger one does."""
    one = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(column).alias("label"))
    rows = docs.where(~held_out(F.col("doc_id")))
    return rows.join(one.where(F.col("label").isin(0, 1)), "doc_id")


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), text_key(text).alias("key"))


def sample_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of chosen rows (doc_id, key, label); `wanted` is bounded, so it is broadcast."""
    return docs.join(F.broadcast(wanted), ["doc_id", "key"]).select("text", "label")


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Array, np.ndarray], object]):
    """Fit on a bounded sample of (text, label) in one task; the model comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        texts = pa.concat_arrays([b.column(0) for b in rows]) if rows else pa.array([], pa.string())
        labels = np.concatenate([b.column(1).to_numpy() for b in rows]) if rows else np.zeros(0)
        # The same order whatever the partitions were: the sums below round alike.
        order = pa.compute.sort_indices(
            pa.table({"t": texts, "l": labels}), sort_keys=[("l", "ascending"), ("t", "ascending")]
        )
        model = fit(texts.take(order), labels[order.to_numpy()])
        yield pa.record_batch({"model": pa.array([pickle.dumps(model)], pa.binary())})

    fixed = sample.select("text", F.col("label").cast("int").alias("label"))
    # A shuffle, not coalesce(): the scan below the sample stays spread over all tasks.
    parts = fixed.repartition(1).mapInArrow(run, "model binary")
    found = freeze(parts, "model").collect()
    return pickle.loads(found[0]["model"]) if found else None


def quantiles(rows: DataFrame, *wanted: tuple[Column, float]) -> list[float | None]:
    """For each (column, share) the least value with that share of the column's rows up to it, exactly.
    NULLs don't count; None without rows.

    Each pass over `rows` counts, per quantile, the rows in BINS equal bins between the least and
    the greatest value that it can still be, and goes on in the bin of its rank. What comes back of
    a pass is of a fixed size, and no task holds more than that of a quantile.
    """
    ends = rows.agg(*(f(column) for column, _ in wanted for f in (F.count, F.min, F.max))).first()
    # The rank that is left, and the values between which it is.
    left = {i: (max(1, math.ceil(share * ends[3 * i])), *ends[3 * i + 1 : 3 * i + 3]) for i, (_, share) in enumerate(wanted)}
    found = {i: low for i, (_, low, high) in left.items() if low == high}
    while left := {i: at for i, at in left.items() if at[1] != at[2]}:
        places = []
        for i, (_, low, high) in left.items():
            x = wanted[i][0]
            place = F.least(F.floor((x - low) / (high - low) * BINS).cast("int"), F.lit(BINS - 1))
            one = F.struct(F.lit(i).alias("i"), place.alias("bin"), x.alias("x"))
            places.append(F.when(x.between(low, high), one))
        each = rows.select(F.explode(F.array_compact(F.array(*places))).alias("at")).select("at.*")
        counted = each.groupBy("i", "bin").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        bins = sorted(counted.collect())
        for i, (rank, _, _) in left.items():
            for _, _, n, low, high in (row for row in bins if row["i"] == i):
                if rank <= n:
                    left[i] = (rank, low, high)
                    break
                rank -= n
        found |= {i: low for i, (_, low, high) in left.items() if low == high}
    return [found.get(i) for i in range(len(wanted))]


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def score(docs: DataFrame, scorer: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """(doc_id, key, score) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(scorer(batch.column(1)), pa.float64())],
                names=["doc_id", "key", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "key").mapInArrow(run, f"doc_id {kind}, key string, score double")
