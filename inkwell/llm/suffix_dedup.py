"""Repeated passages, by a distributed merge sort of suffixes.

Bytes are removed that lie in a string of LENGTH bytes which starts anywhere else too. Not all
suffixes are sorted. A suffix is an anchor if the hash of its first GRAM = LENGTH / 2 bytes is
the least within some string of LENGTH bytes. That depends on the string alone, so equal
strings have their anchors at equal places: if the strings at i and j are equal, an anchor p
in the first has a twin q in the second, and around them the texts agree over LENGTH bytes.
Anchors whose first GRAM bytes occur once are dropped after a count. The others are sorted:

1. Each task sorts its anchors' suffixes (LENGTH bytes of them) into a run. Anchors with equal
   surroundings are one entry, so a run has each copy once. A run is cut into blocks by the first
   bytes and front-coded: an entry holds how many bytes it shares with the one before.
2. Blocks are exchanged by range and merged by a loser tree that keeps, for every run, how much
   its next entry shares with the last one put out. Entries with different such lengths are
   ordered by them alone; equal ones are compared from there on only.
3. The merged order gives the common prefixes, and a sort of the reversed bytes in front of the
   anchors gives the common suffixes. A string that starts `o` bytes before p is repeated if
   another entry agrees on `o` bytes to the left and LENGTH - o to the right; the largest and the
   smallest such `o` bound what p's anchor covers. No hash decides about removal.

Cases: NULL text is empty; texts shorter than LENGTH keep all bytes; rows that repeat id and text
repeat each other's bytes; an empty table gives no rows. Other columns are ignored.
"""

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.features import text_buffers
from inkwell.sources.scratch import freeze

LENGTH = 400
PREFIX = 24  # bytes that name a block
RUN_BYTES = 32 << 20  # a run is closed when it holds as much

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_ENTRY = "<HHHIB"  # shared bytes, further bytes, bytes to the left, number, repeated
_tables: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        size = max(n, 1 << 16)
        _tables.clear()
        for base in (_BASE, _INVERSE):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _tables.append(np.cumprod(row, dtype=np.uint64))
    return _tables


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """least (np.minimum or np.maximum) of every `width` values in a row."""
    n = len(values)
    fill = np.uint64(0xFFFFFFFFFFFFFFFF) if least is np.minimum else np.uint64(0)
    blocks = np.concatenate([values, np.full(-n % width, fill, np.uint64)]).reshape(-1, width)
    ahead = least.accumulate(blocks, axis=1).ravel()
    back = least.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return least(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text's anchors and the hashes of their first length / 2 bytes."""
    n, gram = len(data), length // 2
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    power, inverse = _powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * inverse[:n], dtype=np.uint64, out=total[1:])
    h = (total[gram:] - total[:-gram]) * power[: n - gram + 1]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    width = length - gram + 1
    lowest = _sliding(h, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    reached = _sliding(np.concatenate([edge, lowest, edge]), width, np.maximum)
    at = np.flatnonzero(reached == h)
    return at, h[at]


def common(a: bytes, b: bytes, known: int) -> int:
    """How many bytes a and b share, given that they share `known`."""
    n = min(len(a), len(b))
    step = 8
    while known < n and a[known : known + step] == b[known : known + step]:
        known, step = min(n, known + step), step * 2
    high = min(n, known + step)
    while known < high:  # binary search for the first difference
        middle = (known + high + 1) // 2
        if a[known:middle] == b[known:middle]:
            known = middle
        else:
            high = middle - 1
    return known


def encode(entries: list[tuple[bytes, bytes, int, bool]]) -> bytes:
    """A front-coded block of sorted (suffix, left, number, repeated)."""
    out, before = [], b""
    for suffix, left, number, repeated in entries:
        shared = common(before, suffix, 0)
        out.append(struct.pack(_ENTRY, shared, len(suffix) - shared, len(left), number, repeated))
        out += (suffix[shared:], left)
        before = suffix
    return b"".join(out)


def decode(block: bytes) -> Iterator[tuple[int, bytes, bytes, int, int]]:
    """(shared, suffix, left, number, repeated) of a block's entries in order."""
    at, before = 0, b""
    while at < len(block):
        shared, more, n_left, number, repeated = struct.unpack_from(_ENTRY, block, at)
        at += struct.calcsize(_ENTRY)
        before = before[:shared] + block[at : at + more]
        yield shared, before, block[at + more : at + more + n_left], number, repeated
        at += more + n_left


def merge(runs: list[Iterator]) -> Iterator[tuple[int, int, tuple]]:
    """Merge sorted runs of (shared, suffix, ...) with a loser tree: (run, shared, entry), `shared`
    with the entry put out before. Prefixes known to be equal are not compared again."""
    k = len(runs)
    heads = [next(r, None) for r in runs]
    known = [0] * k  # what each head shares with the last entry put out

    def first(a: int, b: int) -> tuple[int, int]:
        """The earlier of two heads and the other one, whose known prefix is brought up to date."""
        if heads[a] is None or heads[b] is None:
            return (a, b) if heads[b] is None else (b, a)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        x, y = heads[a][1], heads[b][1]
        shared = common(x, y, known[a])
        if shared == len(x) == len(y):
            win, lose = (a, b) if a < b else (b, a)
        elif shared == len(x) or (shared < len(y) and x[shared] < y[shared]):
            win, lose = a, b
        else:
            win, lose = b, a
        known[lose] = shared
        return win, lose

    losers = [0] * k

    def play(node: int) -> int:
        if node >= k:
            return node - k
        win, losers[node] = first(play(2 * node), play(2 * node + 1))
        return win

    winner = play(1) if k > 1 else 0
    while heads[winner] is not None:
        yield winner, known[winner], heads[winner]
        heads[winner] = following = next(runs[winner], None)
        if following is not None:
            known[winner] = following[0]  # it shares with the one put out what it shares in its run
        node = (winner + k) // 2
        while node >= 1 and k > 1:
            winner, losers[node] = first(winner, losers[node])
            node //= 2


def coverage(group: list[tuple[bytes, bytes, bool]], shared: list[int], length: int) -> list[tuple[int, int] | None]:
    """For sorted distinct-by-run entries (suffix, left, repeated) that share their first half: how
    far back and ahead repeated strings reach around each, or None. `shared`: with the one before."""
    n, half = len(group), length // 2
    back, least = np.full(n, -1), np.full(n, length + 1)
    for i, (suffix, left, repeated) in enumerate(group):
        if repeated and len(left) + len(suffix) >= length:
            back[i], least[i] = len(left), length - len(suffix)
    if n > 1:
        turned = [left[::-1] for _, left, _ in group]
        order = sorted(range(n), key=turned.__getitem__)
        to_left = np.array([common(turned[a], turned[b], 0) for a, b in zip(order, order[1:])])
        to_right = np.array(shared[1:]) - half
        offsets = np.unique(np.concatenate([to_left, half - to_right]))
        left_class, right_class = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for o in offsets[(offsets >= 0) & (offsets <= half)]:
            left_class[order] = np.concatenate([[0], np.cumsum(to_left < o)])
            right_class[1:] = np.cumsum(to_right < half - o)
            _, which, count = np.unique(right_class * n + left_class, return_inverse=True, return_counts=True)
            often = count[which] > 1
            back[often] = np.maximum(back[often], o)
            least[often] = np.minimum(least[often], o)
    return [(int(b), length - int(m)) if b >= 0 else None for b, m in zip(back, least)]


class _Run:
    """Entries of one run, and where each occurs."""

    def __init__(self, name: int):
        self.name, self.bytes = name, 0
        self.entries: dict[tuple[bytes, bytes], list[tuple[int, int]]] = {}

    def add(self, text: bytes, places, row: int, length: int) -> None:
        half = length // 2
        for p in places:
            entry = (text[p : p + length], text[max(0, p - half) : p])
            at = self.entries.setdefault(entry, [])
            if not at:
                self.bytes += len(entry[0]) + len(entry[1]) + 200
            at.append((row, p))


SORTED = "prefix binary, run long, block binary, number int, place int, n_bytes long, kept_sha256 string, bytes binary"


def _runs(docs: DataFrame, length: int) -> DataFrame:
    """From (doc_id, hash, text, places): for a text without places its size and digest; for others
    their bytes; one row per block of a run; one row per occurrence of an entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, runs = TaskContext.get().partitionId(), 0
        current, ids = _Run(task << 24), []

        def rows(kind_ids, **columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            arrays = {"doc_id": kind_ids[0], "hash": kind_ids[1]}
            for spec in SORTED.split(", "):
                name, kind = spec.split()
                kind = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
                arrays[name] = pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind)
            return pa.record_batch(arrays)

        def close() -> Iterator[pa.RecordBatch]:
            blocks: dict[bytes, list] = {}
            number, occurs = 0, []
            for (suffix, left), at in sorted(current.entries.items()):
                blocks.setdefault(suffix[:PREFIX], []).append((suffix, left, number, len(at) > 1))
                occurs += [(number, row, p) for row, p in at]
                number += 1
            none = [pa.nulls(len(blocks), ids[0].type), pa.nulls(len(blocks), pa.int64())]
            if blocks:
                coded = [encode(b) for b in blocks.values()]
                yield rows(none, prefix=list(blocks), run=[current.name] * len(blocks), block=coded)
                of = pa.array([row for _, row, _ in occurs])
                yield rows(
                    [ids[0].take(of), ids[1].take(of)],
                    run=[current.name] * len(occurs),
                    number=[x[0] for x in occurs],
                    place=[x[2] for x in occurs],
                )

        for batch in batches:
            texts = [t.encode() for t in batch.column(2).to_pylist()]
            places = batch.column(3).to_pylist()
            chosen = pa.array([p is None for p in places])
            done = [t for t, p in zip(texts, places) if p is None]
            if done:
                yield rows(
                    [batch.column(c).filter(chosen) for c in (0, 1)],
                    n_bytes=[len(t) for t in done],
                    kept_sha256=[hashlib.sha256(t).hexdigest() for t in done],
                )
            chosen = pa.array([p is not None for p in places])
            kept = [t for t, p in zip(texts, places) if p is not None]
            if not kept:
                continue
            mine = [batch.column(c).filter(chosen) for c in (0, 1)]
            yield rows(mine, bytes=kept)
            base = len(ids[0]) if ids else 0
            ids = [pa.concat_arrays([a, b]) for a, b in zip(ids, mine)] if ids else mine
            for i, (text, at) in enumerate((t, p) for t, p in zip(texts, places) if p is not None):
                current.add(text, sorted(at), base + i, length)
                if current.bytes > RUN_BYTES:
                    yield from close()
                    runs += 1
                    current = _Run(task << 24 | runs)
        if ids:
            yield from close()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "hash", "text", "places").mapInArrow(run, f"doc_id {kind}, hash long, {SORTED}")


def _merged(blocks: DataFrame, length: int) -> DataFrame:
    """(run, number, back, ahead) of the entries that lie in repeated strings."""
    half = length // 2

    def results(block_rows: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
        names = [name for name, _ in block_rows]
        group, shared, tags = [], [], []

        def finish():
            for reach, owners in zip(coverage(group, shared, length), tags):
                if reach:
                    for name, number in owners:
                        yield name, number, *reach

        seen: dict[tuple[bytes, bytes], int] = {}
        for r, known, (_, suffix, left, number, repeated) in merge([decode(b) for _, b in block_rows]):
            if group and known < half:
                yield from finish()
                group, shared, tags, seen = [], [], [], {}
            at = seen.get((suffix, left))
            if at is None:
                seen[suffix, left] = len(group)
                group.append((suffix, left, bool(repeated)))
                shared.append(known)
                tags.append([(names[r], number)])
            else:  # the same surroundings in another run
                group[at] = (suffix, left, True)
                tags[at].append((names[r], number))
        yield from finish()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found) -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
                names=["run", "number", "back", "ahead"],
            )

        prefix, waiting, found = None, [], []
        for batch in batches:
            for p, name, block in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if p != prefix and waiting:
                    found += results(waiting)
                    waiting = []
                prefix = p
                waiting.append((name, block))
            if len(found) > 10_000:
                yield batch_of(found)
                found = []
        if waiting:
            found += results(waiting)
        yield batch_of(found)

    dealt = blocks.select("prefix", "run", "block").repartitionByRange("prefix").sortWithinPartitions("prefix", "run")
    return dealt.mapInArrow(run, "run long, number int, back int, ahead int")


def _cut(texts: DataFrame) -> DataFrame:
    """From (doc_id, hash, bytes, spans): what is removed and a digest of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, digests = [], [], []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                joined: list[list[int]] = []
                for span in sorted((s["start"], s["stop"]) for s in spans or []):
                    if joined and span[0] <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], span[1])
                    else:
                        joined.append(list(span))
                kept, at = hashlib.sha256(), 0
                for start, stop in joined:
                    kept.update(text[at:start])
                    at = stop
                kept.update(text[at:])
                sizes.append(len(text))
                removed.append([{"start": a, "stop": b} for a, b in joined])
                digests.append(kept.hexdigest())
            spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.record_batch(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(removed, spans), pa.array(digests, pa.string())],
                names=["doc_id", "hash", "n_bytes", "spans", "kept_sha256"],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, hash long, n_bytes long, spans array<struct<start:long,stop:long>>, kept_sha256 string"
    return texts.select("doc_id", "hash", "bytes", "spans").mapInArrow(run, schema)


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            found = [anchors(data[a:b], length) for a, b in zip(offsets, offsets[1:])]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(at) for at, _ in found]))
            if len(rows):
                yield pa.record_batch(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(np.concatenate([at for at, _ in found]).astype(np.int32)),
                        pa.array(np.concatenate([h for _, h in found]).astype(np.int64)),
                    ],
                    names=["doc_id", "hash", "place", "gram"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "hash", "text").mapInArrow(run, f"doc_id {kind}, hash long, place int, gram long")


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """One row per document: doc_id, hash (of the text), n_bytes, spans (removed ranges of bytes),
    kept_sha256 (of the bytes that stay)."""
    if length < 2 * PREFIX or length % 2 or length > 60_000:
        raise ValueError("length is even, from 48 to 60,000")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    found = freeze(_anchor_rows(rows, length), "anchors")
    twice = found.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    places = (
        found.join(twice, "gram", "left_semi")
        .groupBy("doc_id", "hash")
        .agg(F.collect_set("place").alias("places"))
    )

    def by_doc(left: DataFrame, right: DataFrame) -> DataFrame:
        named = right.withColumnsRenamed({"doc_id": "_doc", "hash": "_hash"})
        same = left["doc_id"].eqNullSafe(named["_doc"]) & (left["hash"] == named["_hash"])
        return left.join(named, same, "left").drop("_doc", "_hash")

    stored = freeze(_runs(by_doc(rows, places), length), "suffixes")
    reach = freeze(_merged(stored.where(F.col("block").isNotNull()), length), "reach")
    occurs = stored.where(F.col("place").isNotNull()).select("doc_id", "hash", "run", "number", "place")
    span = F.struct((F.col("place") - F.col("back")).alias("start"), (F.col("place") + F.col("ahead")).alias("stop"))
    spans = occurs.join(reach, ["run", "number"]).groupBy("doc_id", "hash").agg(F.collect_set(span).alias("spans"))
    texts = stored.where(F.col("bytes").isNotNull()).select("doc_id", "hash", "bytes")
    untouched = stored.where(F.col("n_bytes").isNotNull()).select(
        "doc_id",
        "hash",
        "n_bytes",
        F.array().cast("array<struct<start:long,stop:long>>").alias("spans"),
        "kept_sha256",
    )
    return untouched.unionByName(_cut(by_doc(texts, spans)))


def kept_bytes(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kept): the bytes of every document that `found` leaves."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash"), text.cast("binary").alias("bytes")
    )
    cuts = found.select(F.col("doc_id").alias("_doc"), F.col("hash").alias("_hash"), "spans").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("hash") == F.col("_hash"))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["stop"]))
    stops = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.octet_length("bytes").cast("long")))
    parts = F.transform(
        F.arrays_zip(starts.alias("a"), stops.alias("b")),
        lambda z: F.hex(F.substring(F.col("bytes"), (z["a"] + 1).cast("int"), (z["b"] - z["a"]).cast("int"))),
    )
    return rows.join(cuts, same).select("doc_id", F.unhex(F.array_join(parts, "")).alias("kept"))


def digests(found: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )
