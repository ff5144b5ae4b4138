"""Importance resampling towards a target, with array-scored weights and distributed quickselect.

Features of a text are its runs of one to three words, hashed into BUCKETS buckets by the crc32 of
their bytes. Counts of all documents and of all target texts give each bucket a gain, the log ratio
of its two smoothed shares in thousandths; a document's weight is the sum of the gains of its
features, taken from an array of gains for a whole Arrow batch. A Gumbel number made of the id's
hash is added, so the documents with the highest scores are a sample without replacement.

The highest k scores are found by quickselect over the whole table: random keys of the part still
in question are the pivots, one pass counts exactly how many keys lie below, at and between them,
and only the part that holds the k-th key stays. Keys are (score descending, doc_id, hash of the
text, number of the row) and never repeat. Only counts and pivots reach the driver; only the
winners are sorted, over all tasks, and ranked.

Cases: NULL and empty texts have no feature, weight 0 and a score, but too few words to be drawn; a
NULL id counts as '' in the hash and comes before other ids in ties; rows that repeat an id are
separate documents, ordered by text; rows that are equal are drawn one by one; an empty table gives
no rows, an empty target only gains by smoothing. A long text is worked off in stretches of STRETCH
bytes. Other columns are ignored.
"""

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.models import narrow
from inkwell.operators.ids import dense_ids
from inkwell.sources.scratch import freeze

BUCKETS = 10_000
RUN = 3  # words
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
PIVOTS = 64
STRETCH = 1 << 20  # bytes

# A-Z in lower case; what is not in a word becomes a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def word_stretches(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + STRETCH)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _buckets(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """For each stretch of a text, its number of words and the buckets of the features that end in it."""
    before: list[bytes] = []
    for words in word_stretches(text):
        joined = before + words
        spaced = [b" " + word for word in joined]
        hashes, found = [crc32(word) for word in joined], []
        for length in range(RUN):
            if length:
                # A run is the run before it and one word more, and so is its checksum.
                hashes = list(map(crc32, spaced[length:], hashes))
            ending = np.array(hashes[max(0, len(before) - length) :], np.int64)
            found.append(ending % BUCKETS)
        yield len(words), np.concatenate(found)
        before = joined[-(RUN - 1) :]


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in _buckets((text.as_py() or "").encode()):
                    total += np.bincount(found, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(used), "n": pa.array(total[used])})

    partial = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long")
    total = np.zeros(BUCKETS, np.int64)
    for bucket, n in partial.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the target's and the source's share of each bucket, in thousandths."""
    all_source, all_target = float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_source + BUCKETS) / ((s + 1) * (all_target + BUCKETS))))
            for s, t in zip(map(float, source), map(float, target))
        ],
        np.int64,
    )


def gumbel(h: int) -> int:
    """A Gumbel number in thousandths from 32 random bits."""
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, n_words, n_features, weight, score) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, h in zip(batch.column(2), batch.column(3).to_pylist()):
                n_words = n_features = weight = 0
                for n, found in _buckets(text.as_py().encode()):
                    n_words, n_features = n_words + n, n_features + len(found)
                    weight += int(gain[found].sum())
                rows.append((n_words, n_features, weight, weight + gumbel(h)))
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.record_batch(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", "key", "n_words", "n_features", "weight", "score"],
            )

    texts = narrow(docs, id_col, text_col)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    bits = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "key", "text", bits.alias("h")).mapInArrow(
        run, f"doc_id {kind}, key string, n_words long, n_features long, weight long, score long"
    )


def _key(order: list[str]) -> Column:
    return F.struct(*order)


def kth(rows: DataFrame, order: list[str], k: int, pivots: int = PIVOTS, seed: int = SEED) -> Column | None:
    """The k-th smallest of the keys `order`, which don't repeat; `rows` must be the same on every
    read. NULL for k = 0 or more rows than there are."""
    types = [rows.schema[name].dataType for name in order]

    def literal(values: tuple) -> Column:
        return F.struct(*(F.lit(v).cast(t).alias(n) for v, t, n in zip(values, types, order)))

    left, before, turn = rows.select(*order), 0, 0
    while k > 0:
        chance = F.xxhash64(F.lit(seed + turn), *order)
        chosen = left.orderBy(chance, *order).limit(pivots).orderBy(*order).collect()
        if not chosen:
            return None
        at = F.array(*(literal(tuple(row)) for row in chosen))
        lower = F.size(F.filter(at, lambda p: p < _key(order)))
        same = F.exists(at, lambda p: p == _key(order))
        sizes = {(r["lower"], r["same"]): r["count"] for r in left.groupBy(lower.alias("lower"), same.alias("same")).count().collect()}
        for place in range(len(chosen) + 1):
            between = sizes.get((place, False), 0)
            if k <= before + between:
                break
            before += between
            if place < len(chosen):
                before += 1
                if k == before:
                    return literal(tuple(chosen[place]))
        else:
            return None
        if place:
            left = left.where(_key(order) > literal(tuple(chosen[place - 1])))
        if place < len(chosen):
            left = left.where(_key(order) < literal(tuple(chosen[place])))
        turn += 1
    return None


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, key, n_words, n_features, weight, score, rank) of every document; `rank` counts the
    drawn ones from 1, NULL for the others."""
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, text_col))
    scored = freeze(
        scores(docs, gain, seed, id_col, text_col)
        .withColumn("minus", -F.col("score"))
        .withColumn("row", F.monotonically_increasing_id()),
        "scores",
    )
    order = ["minus", "doc_id", "key", "row"]
    drawable = scored.where(F.col("n_words") >= least_words)
    last = kth(drawable, order, drawable.count() * percent // 100, seed=seed)
    drawn = F.lit(False) if last is None else (F.col("n_words") >= least_words) & (_key(order) <= last)
    shown = ["doc_id", "key", "n_words", "n_features", "weight", "score"]
    ranked = dense_ids(scored.where(drawn), order, F.lit(1)).select(*shown, F.col("id").cast("long").alias("rank"))
    return scored.where(~drawn).select(*shown, F.lit(None).cast("long").alias("rank")).unionByName(ranked)
