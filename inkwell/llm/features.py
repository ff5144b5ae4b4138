"""Hashed n-gram features of whole texts, vectorised over Arrow batches, and how to fit linear
models on a bounded sample of them.

Feature groups, each with its own 2**BITS buckets:
  words    lower-cased runs of letters, digits and bytes beyond ASCII
  pairs    two words in a row; a word that follows itself falls into one shared bucket
  chars    four bytes in a row, as they are
Hashes depend on the bytes alone, so a text has the same features in every batch and run.
A batch is worked off in pieces of about PIECE bytes; a longer text is a piece of its own.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BITS = 18
SIZE = 1 << BITS
GROUPS = ("words", "pairs", "chars")
PIECE = 1 << 20

_BASE = np.uint32(0x9E3779B1 | 1)
_INVERSE = np.uint32(pow(int(_BASE), -1, 1 << 32))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**32."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, 2 * PIECE)
        tables = []
        for base in (_BASE, _INVERSE):
            row = np.full(size, base, dtype=np.uint32)
            row[0] = 1
            tables.append(np.cumprod(row, dtype=np.uint32))
        _powers[0] = have = tuple(tables)
    return have


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint32(15))
    h = h * np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    return h * np.uint32(0x297A2D39)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and where each begins and ends; NULL is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), offsets


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Consecutive texts of about `size` bytes: their bytes, and offsets into these."""
    data, offsets = text_buffers(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        last = min(last, n)
        yield data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = ()):
    """32-bit hashes of all words, and the text that each is in; with `prefixes`, also those of
    the first so many bytes of each word."""
    n = len(data)
    inside = _IN_WORD[data] if n else np.zeros(0, bool)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True  # a word ends where its text does
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = np.zeros(n + 1, dtype=bool)
    ends[1:] = inside
    ends[1:n] &= ~inside[1:] | edge[1:n]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    power, inverse = _power_tables(n + 1)
    total = np.zeros(n + 1, dtype=np.uint32)
    np.cumsum((_FOLD[data].astype(np.uint32) + np.uint32(1)) * inverse[:n], dtype=np.uint32, out=total[1:])
    owner = np.searchsorted(offsets, starts, side="right") - 1
    hashes = []
    for length in (n, *prefixes):
        upto = np.minimum(stops, starts + length)
        hashes.append(_mixed((total[upto] - total[starts]) * power[starts] + np.uint32(length if length < n else 0)))
    return (hashes[0] if not prefixes else hashes), owner


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows again, cut only where the first column changes."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        token = batch.column(0).to_numpy()
        last = int(np.searchsorted(token, token[-1], side="left"))
        if last or (waiting and waiting[-1].column(0)[-1].as_py() != token[0]):
            yield pa.Table.from_batches([*waiting, batch.slice(0, last)])
            waiting = []
        waiting.append(batch.slice(last))
    if waiting:
        yield pa.Table.from_batches(waiting)


LONG_BASE = 0x9E3779B97F4A7C15 | 1
_LONG_INVERSE = pow(LONG_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """64 well-mixed bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    return h * np.uint64(0x81DADEF4BC2DD44D)


def _long_powers(base: int, n: int) -> np.ndarray:
    row = np.full(max(1, n), base, dtype=np.uint64)
    row[0] = 1
    return np.cumprod(row, dtype=np.uint64)


def long_word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs of anything but white space), the texts that they are in,
    and where they start."""
    n = len(data)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins, ends = inside.copy(), np.zeros(n + 1, dtype=bool)
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends[1:] = inside
    ends[1:n] &= ~inside[1:] | edge[1:n]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(
        (data.astype(np.uint64) + np.uint64(1)) * _long_powers(_LONG_INVERSE, n)[:n], dtype=np.uint64, out=total[1:]
    )
    words = mixed((total[stops] - total[starts]) * _long_powers(LONG_BASE, n + 1)[starts])
    return words, np.searchsorted(offsets, starts, side="right") - 1, starts


def buckets(data: np.ndarray, offsets: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each group: the bucket of every occurrence and the text it is in."""
    shift = np.uint32(32 - BITS)
    words, owner = word_hashes(data, offsets)
    found = {"words": (words >> shift, owner)}
    same_text = owner[1:] == owner[:-1]
    left, right = words[:-1][same_text], words[1:][same_text]
    pair = _mixed(left * np.uint32(0x85EBCA6B) + right)
    pair[left == right] = np.uint32(0xFFFFFFFF)
    found["pairs"] = (pair >> shift, owner[1:][same_text])
    if len(data) >= 4:
        wide = data.astype(np.uint32)
        grams = wide[:-3] | (wide[1:-2] << np.uint32(8)) | (wide[2:-1] << np.uint32(16)) | (wide[3:] << np.uint32(24))
        lengths = np.diff(offsets)
        text = np.repeat(np.arange(len(lengths)), lengths)
        whole = text[:-3] == text[3:]
        found["chars"] = ((_mixed(grams) >> shift)[whole], text[:-3][whole])
    else:
        found["chars"] = (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    return found


def mean_scores(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """bias + the sum over the groups of the mean weight of a text's n-grams; weights: (group, bucket)."""
    out = []
    for data, offsets in pieces(texts):
        n = len(offsets) - 1
        score = np.full(n, bias)
        for g, (bucket, owner) in enumerate(buckets(data, offsets).values()):
            total = np.bincount(owner, weights=weights[g][bucket], minlength=n)
            score += total / np.maximum(1, np.bincount(owner, minlength=n))
        out.append(score)
    return np.concatenate(out) if out else np.zeros(0)


class Sample:
    """Features of a bounded sample as sparse rows (mean frequencies of all groups)."""

    def __init__(self, texts: pa.Array):
        rows, columns, values, first = [], [], [], 0
        for data, offsets in pieces(texts):
            n = len(offsets) - 1
            for g, (bucket, owner) in enumerate(buckets(data, offsets).values()):
                count = np.maximum(1, np.bincount(owner, minlength=n))
                key, number = np.unique(owner.astype(np.int64) * SIZE + bucket, return_counts=True)
                rows.append((key // SIZE + first).astype(np.int32))
                columns.append((key % SIZE + g * SIZE).astype(np.int32))
                values.append((number / count[key // SIZE]).astype(np.float32))
            first += n
        self.n = first
        self.rows = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.columns = np.concatenate(columns) if columns else np.zeros(0, np.int32)
        self.values = np.concatenate(values) if values else np.zeros(0, np.float32)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights=weights[self.columns] * self.values, minlength=self.n)

    def gradient(self, by_row: np.ndarray) -> np.ndarray:
        return np.bincount(
            self.columns, weights=by_row[self.rows] * self.values, minlength=len(GROUPS) * SIZE
        )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Steps for a weight vector."""

    def __init__(self, size: int, rate: float):
        self.rate, self.t = rate, 0
        self.mean, self.square = np.zeros(size), np.zeros(size)

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.999 * self.square + 0.001 * gradient**2
        mean, square = self.mean / (1 - 0.9**self.t), self.square / (1 - 0.999**self.t)
        return self.rate * mean / (np.sqrt(square) + 1e-8)
