r"""Spelling variants: words one code point apart, joined by pivotal bigrams.

Words are counted over all texts. Each word's bigrams are ordered by rarity among the words. Its
prefix is the three rarest and all that are as rare as the third; as one change destroys no
more than two bigrams, two near words share one in both prefixes. Its pivots are two bigrams of the
first three that don't overlap, of the least total frequency, chosen by dynamic programming; one
change destroys no more than one of them. So of two near words the one whose prefix ends earlier in
the order has a pivot that is in the other's prefix, at a place that the change allows: the same
place for words of the same length, and for a word longer by one the same place or the next. Pivots
look up prefixes by place and length. As the change lies on one side of a bigram that it leaves, the
word up to the bigram's end or from its start on is the same in both, so lookups are by the hash of
that part of the word, which fixes bigram and place. The pairs found are verified by edit distance.

A word's form is the near word of the largest count, if that is at least twice the word's. Roots
are found by pointer jumping; counts double at each step, so it ends after a few rounds.

The only thing that is sent to all tasks is the rarity of bigrams, whose number the alphabet bounds
(90 letters: 8,100). A join key with very many words is split by AQE.

Cases: NULL and empty texts have no words; a NULL id counts as ''; rows that repeat count each; ties go to
the word that is smaller in code-point order; an empty table gives no rows. Other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.sources.scratch import freeze

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 97  # one in so many occurrences loses a letter
LEAST_LENGTH = 5
LEAST_COUNT = 3
CHANGES = 1
GRAM = 2
PREFIX = GRAM * CHANGES + 1
FACTOR = 2
LONG = 256


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip: int = SLIP) -> DataFrame:
    """(word) for each run of letters: in lower case, and short of a letter if its hash says so."""
    runs = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(RUN), F.lit(0))
    seen = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run")
    ).select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    place = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    return seen.withColumn("h", h).select(F.when(F.col("h") % slip == 0, less).otherwise(F.col("run")).alias("word"))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return (
        occurrences(docs, id_col, text_col)
        .where(F.length("word") >= LEAST_LENGTH)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


def grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every bigram of every word as a number, the word it is in, and its place from 0."""
    texts = words.to_pylist()
    letters = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
    lengths = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    whole = np.flatnonzero(owner[:-1] == owner[1:]) if len(owner) else np.zeros(0, np.int64)
    return (letters[whole] << 21) | letters[whole + 1], owner[whole], place[whole]


def letter_bits(gram: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """For each of `n` words a bit for each of its letters."""
    bits = np.zeros(n, np.uint64)
    for letter in (gram >> 21, gram & (1 << 21) - 1):
        np.bitwise_or.at(bits, owner, np.uint64(1) << (letter % 64).astype(np.uint64))
    return bits.view(np.int64)


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, n) over the distinct words; as many rows as the alphabet has pairs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, n = np.unique(grams(batch.column(0))[0], return_counts=True)
            yield pa.record_batch({"gram": pa.array(gram, pa.int64()), "n": pa.array(n, pa.int64())})

    return words.select("word").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def pivots(place: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which CHANGES + 1 of each row's grams, sorted by place, don't overlap and have the least
    total weight; the first such by place."""
    n, m = place.shape
    # cost[j]: of the best choice that ends with gram j; earlier[c][j]: the gram before it.
    cost, earlier = weight.astype(np.float64), []
    for _ in range(CHANGES):
        more, previous = np.full((n, m), np.inf), np.zeros((n, m), np.int64)
        for j in range(m):
            for i in range(j):
                apart = place[:, j] - place[:, i] >= GRAM
                total = np.where(apart, cost[:, i] + weight[:, j], np.inf)
                better = total < more[:, j]
                more[better, j], previous[better, j] = total[better], i
        cost = more
        earlier.append(previous)
    chosen = [np.argmin(cost, axis=1)]
    rows = np.arange(n)
    for previous in reversed(earlier):
        chosen.append(previous[rows, chosen[-1]])
    return np.stack(chosen[::-1], axis=1)


def signatures(words: DataFrame) -> DataFrame:
    """(word, n, size, last, letters, prefix, pivots) of words (word, n): `last` is the rank at which the
    prefix ends, `letters` has a bit for each letter of the word (modulo 64); the others are arrays of
    (gram, place), grams by rank."""
    rows = gram_counts(words).orderBy("n", "gram").collect()
    known = np.array([r["gram"] for r in rows], np.int64)
    counts = np.array([r["n"] for r in rows], np.int64)
    by_gram = np.argsort(known)
    in_order = known[by_gram]
    pair = pa.struct([("gram", pa.int32()), ("place", pa.int32())])

    def listed(owner: np.ndarray, gram: np.ndarray, place: np.ndarray, n: int) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
        values = pa.StructArray.from_arrays([pa.array(gram, pa.int32()), pa.array(place, pa.int32())], fields=list(pair))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            gram, owner, place = grams(batch.column(0))
            rank = by_gram[np.searchsorted(in_order, gram)]
            order = np.lexsort((place, rank, owner))
            starts = np.searchsorted(owner, np.arange(n))
            first = order[starts[:, None] + np.arange(PREFIX)]
            last = rank[first[:, -1]]
            within = rank <= last[owner]
            first = np.take_along_axis(first, np.argsort(place[first], axis=1), axis=1)
            chosen = np.take_along_axis(first, pivots(place[first], counts[rank[first]]), axis=1).reshape(-1)
            yield pa.record_batch(
                {
                    "word": batch.column(0),
                    "n": batch.column(1),
                    "size": pa.array(np.bincount(owner, minlength=n) + GRAM - 1, pa.int32()),
                    "last": pa.array(last, pa.int32()),
                    "letters": pa.array(letter_bits(gram, owner, n)),
                    "prefix": listed(owner[within], rank[within], place[within], n),
                    "pivots": listed(np.repeat(np.arange(n), CHANGES + 1), rank[chosen], place[chosen], n),
                }
            )

    arrays = "prefix array<struct<gram: int, place: int>>, pivots array<struct<gram: int, place: int>>"
    return words.select("word", "n").mapInArrow(run, f"word string, n long, size int, last int, letters long, {arrays}")


def one_change(a: str, b: str) -> Column:
    """Whether two columns differ by one inserted, deleted or replaced code point."""
    # Levenshtein's steps grow with the square of a length; for long words the first place where they differ is
    # found, and what follows is compared.
    differ = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: ~x.eqNullSafe(y))
    place = F.array_position(differ, True).cast("int")
    drops = F.length(a) - F.length(b)
    rest = [
        F.substring(F.col(name), place + F.when(sign * drops >= 0, 1).otherwise(0), F.length(name))
        for name, sign in ((a, 1), (b, -1))
    ]
    slow = (place > 0) & (F.abs(drops) <= 1) & (rest[0] == rest[1])
    return F.when(F.length(a) < LONG, F.levenshtein(a, b, 1) == 1).otherwise(slow)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): both directions of every pair of words (word, n) that differ by one
    inserted, deleted or replaced code point."""
    signed = freeze(signatures(words), "signatures").select("*", F.explode(F.array(F.lit("left"), F.lit("right"))).alias("side"))
    # What one side of a bigram holds, with the bigram.
    left, right = F.substring("word", F.lit(1), F.col("at.place") + GRAM), F.substring("word", F.col("at.place") + 1, F.col("size"))
    context = F.xxhash64(F.when(F.col("side") == "left", left).otherwise(right)).alias("context")
    probes = (
        signed.select("word", "n", "size", "last", "letters", "side", F.explode("pivots").alias("at"))
        .select("word", "n", "last", "letters", "side", context, F.explode(F.array(*(F.col("size") + k for k in (0, 1, -1)))).alias("size"))
    )
    index = signed.select("*", F.explode("prefix").alias("at")).select(
        F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("last").alias("near_last"), F.col("letters").alias("near_letters"), "side", context, "size"
    )
    # One change touches two letters at most, which is told faster than the distance.
    alike = F.bit_count(F.col("letters").bitwiseXOR(F.col("near_letters"))) <= 2 * CHANGES
    found = probes.join(index, ["side", "size", "context"]).where((F.col("last") <= F.col("near_last")) & alike & one_change("word", "near"))
    one, other = F.struct("word", "n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"))
    pairs = freeze(found.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct(), "near")

    def way(a: str, b: str) -> DataFrame:
        return pairs.select(
            F.col(f"{a}.word").alias("word"), F.col(f"{a}.n").alias("n"), F.col(f"{b}.word").alias("near"), F.col(f"{b}.n").alias("near_n")
        )

    return way("a", "b").unionByName(way("b", "a"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where following the forms ends."""
    reached = freeze(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = freeze(reached.join(ahead, "root", "left"), "roots")
        reached = further.select("word", F.coalesce("beyond", "root").alias("root"))
        if further.where(F.col("beyond").isNotNull()).isEmpty():
            return reached


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word."""
    words = freeze(word_counts(docs, id_col, text_col), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))
    summed = freeze(
        near_words(words)
        .groupBy("word", "n")
        .agg(F.count("*").alias("n_near"), best.alias("best"))
        .withColumn("has", -F.col("best.minus") >= FACTOR * F.col("n"))
        .select("word", "n_near", F.when(F.col("has"), F.col("best.form")).alias("form"), F.when(F.col("has"), -F.col("best.minus")).alias("form_n")),
        "forms",
    )
    ends = roots(summed.where(F.col("form").isNotNull()))
    return (
        words.join(summed, "word", "left")
        .join(ends, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
    )
