"""Toxicity by non-negative positive-unlabelled learning.

The classifier is logistic in the presence of hashed words and of their first four and five
bytes (inflected and disguised forms share these), divided by the root of their number. It
learns from confirmed toxic documents and from unlabelled text (any documents of the learning
folds) with the class-prior-corrected risk: prior * R+(P) + max(0, R-(U) - prior * R-(P)).
Where the second term turns negative, the step goes against it. The prior is the share of
toxic rows among all labelled rows of the learning folds. A feature that c texts of the sample
have counts c / (c + SHRINK) of its value, so a rare one needs more evidence and none is lost.

The weights are fitted in one task on bounded samples (`POSITIVES`, `UNLABELLED`, by the hash of
id and text). The prior counts all labels, and every whole text is scored. At the end the
intercept is set so that the share of all documents of the learning folds above 0.5 is the
prior. Labels, language, source and id are no inputs.

Cases: NULL text is empty; an empty text has the intercept's score; repeated rows get equal
scores; without toxic rows every score is 0; an empty table gives no rows. Other columns are
ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import held_out
from inkwell.llm.features import BITS, SIZE, pieces, sigmoid, word_hashes
from inkwell.llm.models import fit_in_task, hash_order, labelled, logistic, narrow, quantiles, sample_of, score
from inkwell.sources.scratch import freeze

POSITIVES, UNLABELLED = 2500, 6000
EPOCHS, RATE, MOMENTUM = 150, 60.0, 0.9
SHRINK = 5
THRESHOLD = 0.5
PREFIXES = (4, 5)
WIDTH = SIZE * (1 + len(PREFIXES))


def present(texts: pa.Array):
    """Which features occur in which text: rows, columns, number of texts."""
    rows, columns, first = [], [], 0
    for data, offsets in pieces(texts):
        hashes, owner = word_hashes(data, offsets, PREFIXES)
        base = owner.astype(np.int64) * WIDTH
        keys = [base + g * SIZE + (h >> np.uint32(32 - BITS)) for g, h in enumerate(hashes)]
        key = np.unique(np.concatenate(keys))
        rows.append(key // WIDTH + first)
        columns.append(key % WIDTH)
        first += len(offsets) - 1
    none = np.zeros(0, np.int64)
    return np.concatenate(rows or [none]), np.concatenate(columns or [none]), first


def linear(weights, rows, columns, n):
    size = np.sqrt(np.maximum(1, np.bincount(rows, minlength=n)))
    return np.bincount(rows, weights=weights[columns], minlength=n) / size


def fit_positive_unlabelled(prior: float):
    def fit(texts: pa.Array, labels: np.ndarray):
        """The weights. Label 1: confirmed; 0: unlabelled."""
        positive, unlabelled = labels == 1, labels == 0
        if not positive.any() or not unlabelled.any():
            return None
        rows, columns, n = present(texts)
        size = np.sqrt(np.maximum(1, np.bincount(rows, minlength=n)))
        count = np.bincount(columns, minlength=WIDTH)
        trust = count / (count + SHRINK)
        value = trust[columns] / size[rows]
        weights, bias, speed = np.zeros(WIDTH), np.log(prior / (1 - prior)), 0.0
        n_p, n_u = positive.sum(), unlabelled.sum()
        for _ in range(EPOCHS):
            s = np.bincount(rows, weights=weights[columns] * value, minlength=n) + bias
            p, as_negative = sigmoid(s), np.logaddexp(0, s)
            rest = as_negative[unlabelled].mean() - prior * as_negative[positive].mean()
            of_rest = unlabelled * p / n_u - prior * positive * p / n_p
            pull = prior * positive * (p - 1) / n_p + of_rest if rest >= 0 else -of_rest
            speed = MOMENTUM * speed + np.bincount(columns, weights=pull[rows] * value, minlength=WIDTH)
            weights -= RATE * speed
            bias -= 0.3 * pull.sum()
        return (weights * trust).astype(np.float32)

    return fit


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, key (of the text), held_out, score, predicted; labels: doc_id, toxic."""
    rows = narrow(docs, id_col, text_col)
    known = labelled(rows, labels, "toxic")
    prior = labels.where(~held_out(F.col("doc_id"))).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    prior = min(max(prior or 0.0, 1e-4), 0.9)
    confirmed = hash_order(known.where(F.col("label") == 1).select("doc_id", "key", "label"), POSITIVES)
    anything = hash_order(
        rows.where(~held_out(F.col("doc_id"))).select("doc_id", "key", F.lit(0).alias("label")), UNLABELLED
    )
    weights = fit_in_task(sample_of(rows, confirmed.unionByName(anything)), fit_positive_unlabelled(prior))

    if weights is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        margins = score(rows, lambda texts: linear(weights, *present(texts))).withColumnRenamed("score", "margin")
        margins = freeze(margins, "margin")
        learnable = margins.where(~held_out(F.col("doc_id")))
        bound = quantiles(learnable, (F.col("margin"), 1 - prior))[0]
        # Halfway to the next higher margin, so that documents at the quantile itself stay below.
        above = learnable.where(F.col("margin") > bound).agg(F.min("margin")).first()[0]
        bound = bound if above is None else (bound + above) / 2
        scored = margins.withColumn("score", logistic(F.col("margin") - bound))

    return scored.select(
        "doc_id",
        "key",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
