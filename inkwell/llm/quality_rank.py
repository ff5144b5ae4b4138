"""Quality by Bradley-Terry pairwise ranking.

A document's worth is linear in the mean frequencies of its hashed word, word pair and character
n-grams. It is learned from preference pairs (a good document over a bad one) by logistic loss
on the difference of their features; every epoch pairs the sample anew. The threshold lies
between two quantiles of worth: that of the good documents with the share `TAIL` below it and
that of the bad ones with that share above it, at a third of the way from the bad to the good.
Worth maps to a score of 0.3 at the threshold.

The weights are fitted in one task on a bounded sample (`PER_CLASS` rows of each label, by the hash
of id and text). Every whole text is scored, and the quantiles are taken over all labelled
documents of the learning folds, sampled or not. Labels, language, source and id are no inputs.

Cases: NULL text is empty; an empty text has worth 0 (and gets a score like any other);
repeated rows get equal scores; without documents of both labels every score is 0.5, so
nothing is rejected; an empty table gives no rows. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import held_out
from inkwell.llm.features import GROUPS, SIZE, Adam, Sample, mean_scores, sigmoid
from inkwell.llm.models import fit_in_task, hash_order, labelled, logistic, narrow, quantiles, sample_of, score
from inkwell.sources.scratch import freeze

PER_CLASS = 2000
EPOCHS = 40
THRESHOLD = 0.3
TAIL = 0.002
SHARE = 1 / 3


def fit_pairs(texts: pa.Array, labels: np.ndarray):
    """The weights; None without both labels. Labels are sorted."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return None
    features = Sample(texts)
    weights, rng = np.zeros(len(GROUPS) * SIZE), np.random.default_rng(1)
    adam, n = Adam(len(weights), 0.5), max(len(good), len(bad))
    for _ in range(EPOCHS):
        worth = features.scores(weights)
        better, worse = good[rng.permutation(n) % len(good)], bad[rng.permutation(n) % len(bad)]
        pull = sigmoid(worth[worse] - worth[better]) / n
        by_row = np.bincount(worse, pull, features.n) - np.bincount(better, pull, features.n)
        weights -= adam.step(features.gradient(by_row) + 1e-6 * weights)
    return weights.reshape(len(GROUPS), SIZE).astype(np.float32)


def cut(known: DataFrame) -> tuple[float, float]:
    """(threshold, scale) of the worth of documents (label, worth) of both labels."""
    worth = {c: F.when(F.col("label") == c, F.col("worth")) for c in (0, 1)}
    bad, good, middle_bad, middle_good = quantiles(
        known, (worth[0], 1 - TAIL), (worth[1], TAIL), (worth[0], 0.5), (worth[1], 0.5)
    )
    return bad + SHARE * (good - bad), max(1e-6, middle_good - middle_bad) / 6


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, key (of the text), score, held_out, predicted; labels: doc_id, quality."""
    rows = narrow(docs, id_col, text_col)
    known = labelled(rows, labels, "quality")
    wanted = [
        hash_order(known.where(F.col("label") == c).select("doc_id", "key", "label"), PER_CLASS)
        for c in (0, 1)
    ]
    weights = fit_in_task(sample_of(rows, wanted[0].unionByName(wanted[1])), fit_pairs)

    if weights is None:
        scored = rows.withColumn("score", F.lit(0.5))
    else:
        worths = score(rows, lambda texts: mean_scores(texts, weights, 0.0)).withColumnRenamed("score", "worth")
        worths = freeze(worths, "worth")
        threshold, scale = cut(freeze(labelled(worths, labels, "quality").select("label", "worth"), "known"))
        lift = float(np.log(THRESHOLD / (1 - THRESHOLD)))
        scored = worths.withColumn("score", logistic((F.col("worth") - threshold) / scale + lift))

    return scored.select(
        "doc_id",
        "key",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
