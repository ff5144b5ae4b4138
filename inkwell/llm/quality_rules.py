"""Quality rules: base counts of every text, and a learned rule with a calibrated probability.

The learned rule is a logistic regression on the mean frequencies of hashed word, word pair
and character n-grams, trained on labelled quality rows. Its margin is calibrated (a
logistic curve of it, fitted to a quarter of the sample that the weights have not seen) and
compared with the fixed threshold `KEEP_AT`. Texts are scored whole, in Arrow batches.

The sample is bounded (`PER_CLASS` rows of each label, by the hash of id and text) and fitted
in one task. Labels, language, source and id are no inputs.

Cases: NULL text has no words and fails the base rules; repeated rows get equal results;
without documents of both labels only the base rules hold; an empty table gives no rows.
Other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.features import GROUPS, SIZE, Adam, Sample, mean_scores, sigmoid
from inkwell.llm.models import fit_in_task, hash_order, labelled, narrow, sample_of

PER_CLASS = 2000
EPOCHS = 40
KEEP_AT = 0.3

# Fixed values.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    pairs = np.unique(code[:-1] * len(ids) + code[1:], return_inverse=True)[1]
    windows = pairs[:-1] * np.int64(n) + pairs[1:]
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    often = count[which] >= 2
    inside = np.zeros(n, dtype=bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= often
    return int(inside.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """COUNTS of one text."""
    words = text.encode().split()  # of bytes, split() knows ASCII white space only
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def fit_logistic(texts: pa.Array, labels: np.ndarray):
    """(weights, slope, intercept) of the calibrated probability; None without both labels."""
    if len(np.unique(labels)) < 2:
        return None
    features = Sample(texts)
    share = np.where(labels == 1, (labels == 0).sum(), (labels == 1).sum()) / len(labels)  # classes weigh alike
    unseen = np.random.default_rng(1).random(len(labels)) < 0.25
    learn, check = np.where(unseen, 0, share), np.where(unseen, share, 0)
    weights, bias = np.zeros(len(GROUPS) * SIZE), 0.0
    adam = Adam(len(weights), 0.5)
    for _ in range(EPOCHS):
        p = sigmoid(features.scores(weights) + bias)
        pull = learn * (p - labels) / learn.sum()
        weights -= adam.step(features.gradient(pull) + 1e-6 * weights)
        bias -= pull.sum()
    margin = features.scores(weights) + bias
    slope, intercept = 1.0, 0.0
    # Two parameters, by Newton's method. Labels are smoothed, so the curve stays finite.
    wanted = np.where(labels == 1, 1 - 1e-3, 1e-3)
    for _ in range(25):
        p = sigmoid(slope * margin + intercept)
        off, bend = check * (p - wanted), check * p * (1 - p) + 1e-12
        gradient = np.array([(off * margin).sum(), off.sum()])
        hessian = np.array([[(bend * margin**2).sum(), (bend * margin).sum()], [(bend * margin).sum(), bend.sum()]])
        step = np.linalg.solve(hessian + 1e-6 * np.eye(2), gradient)
        slope, intercept = slope - np.clip(step[0], -1, 1), intercept - np.clip(step[1], -1, 1)
    return weights.reshape(len(GROUPS), SIZE).astype(np.float32), float(max(slope, 1e-3)), bias, float(intercept)


def apply_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, COUNTS, base_failed, probability, kept; labels: doc_id, quality."""
    rows = narrow(docs, id_col, text_col)
    known = labelled(rows, labels, "quality")
    wanted = [
        hash_order(known.where(F.col("label") == c).select("doc_id", "key", "label"), PER_CLASS)
        for c in (0, 1)
    ]
    model = fit_in_task(sample_of(rows, wanted[0].unionByName(wanted[1])), fit_logistic)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            counts = np.array([base_counts(t) for t in texts.to_pylist()], dtype=np.int64).reshape(-1, 5)
            if model is None:
                probability = np.ones(len(texts))
            else:
                weights, slope, bias, intercept = model
                probability = sigmoid(slope * mean_scores(texts, weights, bias) + intercept)
            columns = [batch.column(0), *(pa.array(c) for c in counts.T), pa.array(probability)]
            yield pa.record_batch(columns, names=["doc_id", *COUNTS, "probability"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, probability double"
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        rows.select("doc_id", "text")
        .mapInArrow(run, schema)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= KEEP_AT))
    )
