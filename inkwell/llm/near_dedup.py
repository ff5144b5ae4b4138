"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of five words (all its words if there are fewer), hashed. The
weight of a shingle is tf * (1 + log_N(N / df)): its occurrences in the text, times a factor from 1 (in
all N documents) to 2 (in one). df comes from a counting sketch over all documents: 2**20 cells,
less the mean load of a cell. The sketch has a fixed size, so it can be sent to every task; two
texts see the same weight for the same shingle, whatever its error.

Every text gets BANDS * ROWS samples by improved consistent weighted sampling: two texts agree
on a sample with the probability of their weighted Jaccard similarity J, so a pair at J = 0.8
shares a band with the probability 1 - (1 - 0.8**ROWS)**BANDS = 0.99996. Copies are one text from
here on. In each bucket every text is first compared with one text of the bucket, a random one
so that buckets differ; what is found similar (J >= 0.8, on whole texts) is joined up. Buckets
that are not in one component by then are compared in full, in blocks of BLOCK texts and by
matrix products, and put out the few links that join components, never the pairs. So no
candidate pair that could join two components is left out.

Cases: NULL text is empty; texts without words are near duplicates of equal texts only;
repeated rows are copies; NULL ids belong to classes but name none unless there is no other;
an empty table gives no rows. Other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import text_key
from inkwell.llm.features import LONG_BASE, long_word_hashes, mixed, pieces, whole_groups
from inkwell.llm.graph import components
from inkwell.llm.sketch import count_cells
from inkwell.sources.scratch import freeze

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 10, 2
CELL_BITS = 20
ID_BITS = 44
BLOCK = 512  # texts of a bucket that meet those of another block in one task
COLUMNS = 1 << 12  # shingles that are multiplied at once
DRAWS = 1 << 16  # distinct random triples; a shingle picks one for each sample

def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text: the text, the 44-bit id, the number of occurrences; sorted
    by text and id."""
    words, owner, _ = long_word_hashes(data, offsets)
    count = np.bincount(owner, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    # Sums of five words in a row that don't leave the text; shorter texts have one sum.
    summed = np.zeros(len(words), dtype=np.uint64)
    place = np.arange(len(words)) - first[owner]
    for j in range(SHINGLE):
        has = place + j < count[owner]
        at = np.minimum(np.arange(len(words)) + j, max(0, len(words) - 1))
        summed += np.where(has, words[at] if len(words) else words, np.uint64(j + 1)) * np.uint64(pow(LONG_BASE, 2 * j + 3, 1 << 64))
    is_start = (place == 0) | (place + SHINGLE <= count[owner])
    key = (owner[is_start].astype(np.uint64) << np.uint64(ID_BITS)) | (
        mixed(summed[is_start]) >> np.uint64(64 - ID_BITS)
    )
    key, tf = np.unique(key, return_counts=True)
    return (key >> np.uint64(ID_BITS)).astype(np.int64), key & np.uint64((1 << ID_BITS) - 1), tf


def cells(ids: np.ndarray) -> np.ndarray:
    return (ids >> np.uint64(ID_BITS - CELL_BITS)).astype(np.int64)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """The sketch's cells, less the mean load, and the number of documents, over all `texts`."""

    total, documents = count_cells(texts, CELL_BITS, lambda data, offsets: cells(shingles(data, offsets)[1]))
    load = (total.sum() - total) / (len(total) - 1)
    return np.clip(total - load, 1, max(1, documents)).astype(np.float32), documents


class Sampler:
    """Weights and consistent weighted samples under a given document frequency sketch."""

    def __init__(self, frequencies: np.ndarray, documents: int):
        rarity = np.log(max(2, documents) / frequencies) / np.log(max(2, documents))
        self.factor = (1 + np.maximum(0, rarity)).astype(np.float32)

    def weigh(self, ids: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return tf.astype(np.float32) * self.factor[cells(ids)]

    @staticmethod
    def draws():
        rng = np.random.default_rng(20)
        r = rng.gamma(2, 1, DRAWS).astype(np.float32) + np.float32(1e-3)
        log_c = np.log(rng.gamma(2, 1, DRAWS)).astype(np.float32)
        steps = [np.uint64(int(x) | 1) for x in rng.integers(1 << 62, 1 << 63, BANDS * ROWS)]
        return r, log_c, rng.random(DRAWS, dtype=np.float32), steps

    def bands(self, owner: np.ndarray, ids: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
        """An (n, BANDS) array of band hashes; texts without shingles get zeros."""
        r, log_c, beta, steps = self.draws()
        out = np.zeros((n, BANDS), dtype=np.uint64)
        if not len(ids):
            return out.astype(np.int64)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        texts, sizes = owner[starts], np.diff(np.r_[starts, len(owner)])
        log_w = np.log(weights)
        for k, step in enumerate(steps):
            draw = ((ids + np.uint64(1)) * step) >> np.uint64(48)
            rate, shift = r[draw], beta[draw]
            t = np.floor(log_w / rate + shift)
            a = log_c[draw] - rate * (t - shift + 1)
            least = np.minimum.reduceat(a, starts)
            hit = np.flatnonzero(a == np.repeat(least, sizes))
            hit = hit[np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]]
            sample = mixed(ids[hit] * np.uint64(0xD6E8FEB86659FD93) + t[hit].astype(np.int64).astype(np.uint64))
            band = k // ROWS
            out[texts, band] = mixed(out[texts, band] * np.uint64(31) + sample + np.uint64(band + 1))
        return out.astype(np.int64)


def _signatures(rows: DataFrame, sampler: Sampler) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data, offsets in pieces(batch.column(2)):
                owner, ids, tf = shingles(data, offsets)
                found.append(sampler.bands(owner, ids, sampler.weigh(ids, tf), len(offsets) - 1))
            bands = np.concatenate(found) if found else np.zeros((0, BANDS), np.int64)
            listed = pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(pa.list_(pa.int64()))
            yield pa.record_batch([batch.column(0), batch.column(1), listed], names=["doc_id", "key", "bands"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key string, bands array<long>"
    return rows.select("doc_id", "key", "text").mapInArrow(run, schema)


def _vectors(texts: DataFrame, sampler: Sampler) -> DataFrame:
    """(key, ids, weights) of texts (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for data, offsets in pieces(batch.column(1)):
                n = len(offsets) - 1
                owner, ids, tf = shingles(data, offsets)
                weights, cut = sampler.weigh(ids, tf), np.searchsorted(owner, np.arange(n + 1))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, n),
                        pa.array([ids[a:b].astype("<i8").tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                        pa.array([weights[a:b].astype("<f4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                    ],
                    names=["key", "ids", "weights"],
                )
                first += n

    return texts.select("key", "text").mapInArrow(run, "key string, ids binary, weights binary")


def weighted_jaccard(ids_a, weights_a, ids_b, weights_b) -> float:
    """Of two vectors whose ids are sorted."""
    _, at_a, at_b = np.intersect1d(ids_a, ids_b, assume_unique=True, return_indices=True)
    both = float(np.minimum(weights_a[at_a], weights_b[at_b]).sum(dtype=np.float64))
    union = float(weights_a.sum(dtype=np.float64)) + float(weights_b.sum(dtype=np.float64)) - both
    return both / union if union > 0 else 0.0


def _verified(pairs: DataFrame, vectors: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = lambda c, i, kind: np.frombuffer(batch.column(c)[i].as_py(), kind)
            keep = [
                weighted_jaccard(vector(2, i, "<i8"), vector(3, i, "<f4"), vector(4, i, "<i8"), vector(5, i, "<f4"))
                >= similar
                for i in range(batch.num_rows)
            ]
            chosen = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column(c).filter(chosen) for c in (0, 1)], names=["a", "b"])

    of = lambda c: vectors.select(*(F.col(x).alias(f"{x}_{c}") for x in ("key", "ids", "weights")))
    joined = pairs.join(of("a"), F.col("a") == F.col("key_a")).join(of("b"), F.col("b") == F.col("key_b"))
    return joined.select("a", "b", "ids_a", "weights_a", "ids_b", "weights_b").mapInArrow(run, "a string, b string")


def joining_links(
    vectors: list[tuple[np.ndarray, np.ndarray]], component: np.ndarray, similar: float
) -> Iterator[tuple[int, int]]:
    """Links between texts (ids, weights) of different components; components that one of these
    links has joined are one from then on."""
    n = len(vectors)
    component = np.unique(component, return_inverse=True)[1]
    rows = np.repeat(np.arange(n), [len(ids) for ids, _ in vectors])
    ids, weights = (np.concatenate([v[k] for v in vectors]) for k in (0, 1))
    weights = weights.astype(np.float64)
    sums = np.bincount(rows, weights=weights, minlength=n)
    # A shingle's weight is its factor times its occurrences. The least of two weights is a sum
    # over levels: what both reach of each level.
    order = np.lexsort((weights, ids))
    rows, ids, weights = rows[order], ids[order], weights[order]
    shared = np.r_[False, ids[1:] == ids[:-1]]
    shared |= np.r_[shared[1:], False]
    rows, ids, weights = rows[shared], ids[shared], weights[shared]
    # Of two texts in different components one is outside the largest component.
    outside = np.flatnonzero(component != np.bincount(component).argmax())
    both = np.zeros((len(outside), n))
    while len(rows):
        start = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        column = np.cumsum(np.r_[0, ids[1:] != ids[:-1]])
        level = weights[start]  # sorted: the least weight of each shingle
        for a in range(0, len(start), COLUMNS):
            at = slice(start[a], start[a + COLUMNS] if a + COLUMNS < len(start) else len(rows))
            has = np.zeros((n, min(COLUMNS, len(start) - a)))
            has[rows[at], column[at] - a] = 1
            both += (has[outside] * level[a : a + has.shape[1]]) @ has.T
        weights = weights - level[column]
        more = weights > 0
        rows, ids, weights = rows[more], ids[more], weights[more]
    union = sums[outside, None] + sums[None, :] - both
    alike = (both >= similar * union) & (union > 0)
    for x, i in enumerate(outside):
        others = np.flatnonzero(alike[x])
        for j in others[np.unique(component[others], return_index=True)[1]]:
            if component[j] != component[i]:
                yield int(i), int(j)
                component[component == component[j]] = component[i]


def _joined(members: DataFrame, similar: float) -> DataFrame:
    """Joining links (a, b) among members (cell, key, component, ids, weights) of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches):
            cell, component = rows.column(0).to_numpy(), np.array(rows.column(2).to_pylist())
            starts, found = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), []
            for a, b in zip(starts, [*starts[1:], len(cell)]):
                if len(set(component[a:b])) > 1:
                    part = rows.slice(a, b - a)
                    vectors = [
                        (np.frombuffer(i, "<i8"), np.frombuffer(w, "<f4"))
                        for i, w in zip(part.column(3).to_pylist(), part.column(4).to_pylist())
                    ]
                    found += [(a + i, a + j) for i, j in joining_links(vectors, component[a:b], similar)]
            key = rows.column(1).combine_chunks()
            ends = [key.take(pa.array([f[x] for f in found], pa.int64())) for x in (0, 1)]
            yield pa.record_batch(ends, names=["a", "b"])

    dealt = members.repartition("cell").sortWithinPartitions("cell", "key")
    return dealt.select("cell", "key", "component", "ids", "weights").mapInArrow(run, "a string, b string")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR
) -> DataFrame:
    """One row per document: doc_id, key (of the text), class_id (the smallest id of its class),
    n_class (documents in it), stays (the row that represents it; rows that repeat both id and
    text all have it)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("key"), text.alias("text"))
    sampler = Sampler(*document_frequencies(rows))
    signed = freeze(_signatures(rows, sampler), "signatures")

    # Copies are one text from here on. Texts without words have the band 0 and stay out.
    distinct = signed.groupBy("key").agg(F.first("bands").alias("bands"))
    entries = distinct.select("key", F.posexplode("bands").alias("band", "hash")).where(F.col("hash") != 0)
    order = F.struct(F.xxhash64("band", "hash", "key").alias("order"), "key")
    heads = entries.groupBy("band", "hash").agg(F.min(order)["key"].alias("head"), F.count("*").alias("n"))
    buckets = freeze(entries.join(heads.where(F.col("n") > 1), ["band", "hash"]), "buckets")
    stars = buckets.where(F.col("key") != F.col("head"))
    stars = freeze(stars.select(F.col("head").alias("a"), F.col("key").alias("b")).distinct(), "pairs")
    wanted = buckets.select("key").distinct()
    vectors = freeze(
        _vectors(rows.join(wanted, "key", "left_semi").dropDuplicates(["key"]), sampler), "vectors"
    )
    edges = freeze(_verified(stars, vectors, similar), "links")

    # Buckets that no chain of links has joined yet; equal sets of texts are one bucket.
    named = components(edges)
    placed = buckets.join(named.withColumnRenamed("node", "key"), "key", "left").select(
        "band", "hash", "key", "n", F.coalesce("component", "key").alias("component")
    )
    split = (
        placed.groupBy("band", "hash")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("texts"),
            F.max("n").alias("size"),
        )
        .where(F.col("low") != F.col("high"))
        .groupBy("texts", "size")
        .agg(F.min(F.struct("band", "hash")).alias("one"))
        .select("one.band", "one.hash")
    )
    apart = placed.join(split, ["band", "hash"])
    # A large bucket is cut into blocks; each pair of blocks is a cell.
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    apart = apart.withColumn("own", F.pmod(F.xxhash64("key", "band"), blocks).cast("int"))
    cells_of = apart.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn(
        "cell", F.xxhash64("band", "hash", F.least("own", "other"), F.greatest("own", "other"))
    )
    members = cells_of.select("cell", "key", "component").join(vectors, "key")
    more = freeze(_joined(members, similar), "links")
    named = components(edges.unionByName(more))

    classed = signed.select("doc_id", "key").join(named.withColumnRenamed("node", "key"), "key", "left").select(
        "doc_id", "key", F.coalesce("component", "key").alias("component")
    )
    classes = classed.groupBy("component").agg(
        F.min("doc_id").alias("class_id"),
        F.count("*").alias("n_class"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("one"),
    )
    return classed.join(classes, "component").select(
        "doc_id",
        "key",
        "class_id",
        "n_class",
        (F.col("doc_id").eqNullSafe(F.col("one.doc_id")) & (F.col("key") == F.col("one.key"))).alias("stays"),
    )
