r"""Token ids of whole texts in blocks of static range asymmetric numerals.

One frequency table, counted over all ids, is shared by every block. Ids are put in ascending
order of doc_id, joined, and cut between documents into blocks of at most BLOCK ids; a longer document has
blocks of its own. Blocks are coded on their own: LANES coders take turns id by id (id k belongs to lane k % LANES) and write into one row of words. The
coder's 64-bit state stays between 2**31 and 2**63 and gives off 32 bits at a time. Every
CHECKPOINT rounds the states of all lanes and the place in the words are kept, so the stretches
between checkpoints are read side by side.

An encoded corpus is a folder that Spark's writers commit (a lost executor leaves no half file):

    model    id, frequency; the frequencies add up to 2**SCALE
    blocks   part, block, first, n_ids, whole, payload, pieces; parts ascend with doc_id, blocks
             within a part; first counts the part's ids before the block; whole says that the
             block's documents lie in no other; pieces names these: doc_id, number in the part, n

    payload  little-endian: "IWR1", lanes u2, rounds between checkpoints u2, ids u4, words u4,
             checkpoints u4; then per checkpoint its place in the words u4 and the states u8 * lanes;
             the words u4 *; crc32 of the ids as u4; crc32 of everything before, u4

A reader checks both sums and that each stretch ends in the state that the next one begins with.

Texts are tokenised by pieces between white space (space, tab, line breaks), which no token
crosses for a tokenizer that drops white space, and signs at a piece's end are parted from a letter
before them, for a tokenizer that never joins the two (`signs`: those signs, '' for another
tokenizer). A-Z is folded first if the tokenizer does so itself. Each distinct piece is tokenised once as
long as it is remembered. Memory: a text and its ids, STRETCH bytes of texts in work, and REMEMBERED short pieces.

Cases: NULL and empty texts are the end id alone; NULL ids come first; rows that repeat an id
are ordered by text, equal rows are separate documents; a document of more than BLOCK ids lies in
several blocks; an empty table gives a folder without blocks and no rows. Other columns are ignored.
"""

import gc
import hashlib
import json
import os
import string
import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.llm import features
from inkwell.llm.models import narrow
from inkwell.sources.scratch import freeze

END = 1
BLOCK = 1 << 16
LANES = 32
CHECKPOINT = 512  # rounds
SCALE = 20
TOGETHER = 32  # blocks coded at once

MAGIC = b"IWR1"
HEADER = "<4sHHIII"
LOWEST = 1 << 31

REMEMBERED = 1 << 19  # pieces in a generation
SHORT = 32  # characters of a piece that is remembered
STRETCH = 1 << 23  # bytes of texts worked off at once
JOINED = 50  # pieces tokenised in a call
ALONE = 1 << 12  # characters of pieces that are not joined: offsets of tokens take far more memory than ids
SIGNS = string.punctuation
SIGNS_BEHIND = 8  # signs that are parted from a word


class CorruptBlock(ValueError):
    pass


# Tokenising


class Encoder:
    """Ids of texts. Short pieces are remembered in two generations: when the younger one is
    full it becomes the older one, so pieces that keep coming back are never forgotten."""

    def __init__(self, settings: str, signs: str, folds: bool):
        # Spark runs a task per core, so a tokenizer has one thread.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.signs, self.folds = Tokenizer.from_str(settings), signs, folds
        self.kind = id_type(self.tokenizer.get_vocab_size())
        # An added token is found in a text before it is parted or folded, and folding must make none.
        self.added = [token.content.encode().lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, unseen: list[str]) -> list[bytes]:
        """Ids of pieces. Some are joined by spaces for a call, as a call takes longer than a piece; a
        token is of the piece that it starts in."""
        ids, counts, batches = [], [], []
        for at in range(0, len(unseen), JOINED):
            some = unseen[at : at + JOINED]
            batches += [some] if sum(map(len, some)) < ALONE else [[w] for w in some]
        encoded = self.tokenizer.encode_batch([" ".join(b) for b in batches], add_special_tokens=False)
        for batch, done in zip(batches, encoded):
            own = done.ids
            ids += own
            if len(batch) == 1:
                counts.append([len(own)])
                continue
            begins = np.cumsum([0, *(len(w) + 1 for w in batch[:-1])])
            owner = np.searchsorted(begins, np.array([o[0] for o in done.offsets], np.int64), side="right") - 1
            counts.append(np.bincount(owner, minlength=len(batch)))
        size = np.dtype(self.kind).itemsize
        data = np.array(ids, self.kind).tobytes()
        ends = (np.cumsum(np.concatenate(counts)) * size).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def look_up(self, words: list[str]) -> list[bytes]:
        """Ids of different pieces."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        fresh = [w for w in words if w not in known]
        known.update((w, older[w]) for w in fresh if w in older)
        unseen = [w for w in fresh if w not in known]
        if unseen:
            known.update(zip(unseen, self.learn(unseen)))
        found = [known[w] for w in words]
        for w in unseen:
            if len(w) > SHORT:
                del known[w]
        return found

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts data[offsets[i]:offsets[i + 1]] in a row, and where each text's begin and end."""
        whole = data.tobytes().lower()
        plain = not any(a in whole for a in self.added)
        words, first = parted(data, offsets, self.signs if plain else "", self.folds and plain)
        if not len(words):
            return np.zeros(0, self.kind), np.zeros(len(offsets), np.int64)
        words = words.dictionary_encode()
        found = self.look_up(words.dictionary.to_pylist())
        learned, which = np.frombuffer(b"".join(found), self.kind), words.indices.to_numpy()
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // learned.itemsize
        own = lengths[which]
        before = np.concatenate([[0], np.cumsum(own)])
        small = np.int32 if before[-1] < 1 << 31 else np.int64
        starts = ((np.cumsum(lengths) - lengths)[which] - before[:-1]).astype(small)
        ids = learned[np.repeat(starts, own) + np.arange(before[-1], dtype=small)]
        return ids, before[first]


def worker_encoder(*settings) -> Encoder:
    """This worker process's encoder, which outlives the task: the next one finds its pieces known."""
    kept = vars(sys).setdefault("_inkwell_encoders", {})
    name = (hashlib.sha256(settings[0].encode()).digest(), *settings[1:])
    if name not in kept:
        kept[name] = Encoder(*settings)
    return kept[name]


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def lower_cases(settings: str) -> bool:
    """Whether a tokenizer lower-cases all letters and does nothing before that depends on the case
    of A-Z: it composes or decomposes, or replaces by a pattern without letters but \\s."""
    steps = json.loads(settings).get("normalizer") or {}
    for step in steps.get("normalizers", [steps]):
        if step.get("type") == "Lowercase":
            return True
        blanks = step.get("type") == "Replace" and step["pattern"] in ({"Regex": "\\s+"}, {"Regex": "\\s"})
        if not blanks and step.get("type") not in ("NFC", "NFD", "NFKC", "NFKD"):
            return False
    return False


def blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | (data == 9) | (data == 10) | (data == 13)


def parted(data: np.ndarray, offsets: np.ndarray, signs: str, folds: bool) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts in a row, and how many come before each text.

    A-Z is folded where the next byte is ASCII: before a combining mark the case may decide
    whether there is one sign for both.
    """
    if folds:
        capital = (data >= 65) & (data <= 90)
        capital[:-1] &= data[1:] < 128
        data = data + np.uint8(32) * capital
    solid = ~blank(data)
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[at] = solid[at]
    packed, begins = data[solid], begins[solid]
    starts = np.flatnonzero(begins)
    if signs and len(starts):
        # The last byte of each word that is no sign; words with more than SIGNS_BEHIND signs stay whole.
        sign = np.isin(np.arange(256), [b for b in signs.encode() if b < 128])
        ends = np.append(starts[1:], len(packed))
        left = np.flatnonzero(sign[packed[ends - 1]])
        for behind in range(1, SIGNS_BEHIND + 1):
            left = left[ends[left] - starts[left] > behind]
            last = ends[left] - 1 - behind
            end = packed[last]
            letter = ((end | 32) >= 97) & ((end | 32) <= 122)
            # Letters of Latin-1; others stay with the signs behind them.
            letter |= (end >= 128) & (end != 0x97) & (end != 0xB7) & (packed[last - 1] == 0xC3)
            begins[last[letter] + 1] = True
            left = left[sign[end]]
        starts = np.flatnonzero(begins)
    ends = pa.py_buffer(np.append(starts, len(packed)).astype(np.int64))
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, ends, pa.py_buffer(packed)])
    solid_before = offsets - np.searchsorted(np.flatnonzero(~solid), offsets)
    return words, np.searchsorted(starts, solid_before)


def stretches(data: np.ndarray) -> Iterator[np.ndarray]:
    """A text cut behind white space into about STRETCH bytes each."""
    at, cuts = 0, np.flatnonzero(blank(data))
    while len(data) - at > STRETCH:
        k = np.searchsorted(cuts, at + STRETCH)
        if k == len(cuts):
            break
        yield data[at : cuts[k]]
        at = int(cuts[k])
    yield data[at:]


def tokenized(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = END,
    signs: str = SIGNS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, str]:
    """(doc_id, key, ids) of every whole text, with the end id, and the type that its ids have."""
    with open(tokenizer_path, encoding="utf-8") as file:
        settings = file.read()
    folds = lower_cases(settings)
    kind = Encoder(settings, signs, folds).kind

    def ids_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode, first = worker_encoder(settings, signs, folds), 0
        for data, offsets in features.pieces(batch.column(1), STRETCH):
            n = len(offsets) - 1
            if len(data) > STRETCH:
                parts = [encode(part, np.array([0, len(part)]))[0] for part in stretches(data)]
                ids = np.concatenate(parts)
                bounds = np.array([0, len(ids)])
            else:
                ids, bounds = encode(data, offsets)
            ids = np.insert(ids, bounds[1:], np.array(end_id, kind))
            ends = pa.py_buffer((bounds + np.arange(n + 1)) * ids.itemsize)
            joined = pa.Array.from_buffers(pa.large_binary(), n, [None, ends, pa.py_buffer(ids)])
            rows = batch.slice(first, n)
            first += n
            yield pa.record_batch([rows.column(0), rows.column(2), joined.cast(pa.binary())], names=["doc_id", "key", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Millions of strings come and go and none is in a cycle.
        collecting = gc.isenabled()
        gc.disable()
        try:
            for batch in batches:
                yield from ids_of(batch)
        finally:
            if collecting:
                gc.enable()

    texts = narrow(docs, id_col, text_col)
    doc_id = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {doc_id}, key string, ids binary"), kind


# The shared table


def frequencies(tokens: DataFrame, kind: str) -> DataFrame:
    """(id, n) over all documents: one row per id, so no more than the vocabulary has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=len(total))
            found[: len(total)] += total
            total = found
        used = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    return tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


class Model:
    """Frequencies that add up to 2**SCALE, and the ids that the slots below it belong to."""

    def __init__(self, ids: np.ndarray, frequency: np.ndarray):
        size = int(ids.max()) + 1 if len(ids) else 1
        self.frequency, self.start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.frequency[ids] = frequency
        self.start[ids] = np.cumsum(frequency) - frequency
        self.slots = np.repeat(ids, frequency).astype(np.uint32)
        self.known = self.frequency > 0

    @staticmethod
    def shares(counts: np.ndarray) -> np.ndarray:
        """Every id that occurs gets one part and its share of what is left; the most frequent id
        takes what rounding leaves."""
        if len(counts) > 1 << (SCALE - 1):
            raise ValueError(f"{len(counts)} different ids need a larger SCALE than {SCALE}")
        free = (1 << SCALE) - len(counts)
        total = int(counts.sum())
        shares = np.array([1 + int(n) * free // total for n in counts], np.int64)
        if len(shares):
            shares[np.argmax(counts)] += (1 << SCALE) - shares.sum()
        return shares


# Blocks


def encode(blocks: list[np.ndarray], model: Model) -> list[bytes]:
    """Payloads of blocks, coded side by side, longest first."""
    order = sorted(range(len(blocks)), key=lambda b: -len(blocks[b]))
    rounds = [-(-len(blocks[b]) // LANES) for b in order]
    shape = (rounds[0], len(blocks), LANES)
    ids = np.zeros(shape, np.uint32)
    for b, n in zip(order, rounds):
        # The last round is filled up with the block's first id.
        filled = np.full(n * LANES, blocks[b][0], np.uint32)
        filled[: len(blocks[b])] = blocks[b]
        ids[:n, order.index(b)] = filled.reshape(n, LANES)
    ids = ids.reshape(rounds[0], -1)
    words, written = np.zeros(ids.shape, np.uint32), np.zeros(ids.shape, bool)
    state = np.full(ids.shape[1], LOWEST, np.uint64)
    kept = np.zeros((-(-rounds[0] // CHECKPOINT), len(state)), np.uint64)
    at_work = 0
    for r in range(rounds[0] - 1, -1, -1):
        while at_work < len(blocks) and rounds[at_work] > r:
            at_work += 1
        lanes = slice(0, at_work * LANES)
        now, coded = state[lanes], ids[r, lanes]
        share = model.frequency[coded]
        full = now >= share << np.uint64(63 - SCALE)
        words[r, lanes], written[r, lanes] = now & np.uint64(0xFFFFFFFF), full
        now = np.where(full, now >> np.uint64(32), now)
        turn = now // share
        state[lanes] = (turn << np.uint64(SCALE)) + (now - turn * share) + model.start[coded]
        if r % CHECKPOINT == 0:
            kept[r // CHECKPOINT, lanes] = state[lanes]
    words, written, kept = words.reshape(shape), written.reshape(shape), kept.reshape(-1, *shape[1:])
    out = [b""] * len(blocks)
    for k, (b, n) in enumerate(zip(order, rounds)):
        places = np.concatenate([[0], np.cumsum(written[:, k].sum(axis=1))])
        own = words[:, k][written[:, k]]
        states = kept[: -(-n // CHECKPOINT), k]
        parts = [struct.pack(HEADER, MAGIC, LANES, CHECKPOINT, len(blocks[b]), len(own), len(states))]
        for c, lane_states in enumerate(states):
            parts += [struct.pack("<I", places[c * CHECKPOINT]), lane_states.astype("<u8").tobytes()]
        parts += [own.astype("<u4").tobytes(), struct.pack("<I", zlib.crc32(blocks[b].astype("<u4").tobytes()))]
        payload = b"".join(parts)
        out[b] = payload + struct.pack("<I", zlib.crc32(payload))
    return out


class Block:
    """What a payload holds."""

    def __init__(self, payload: bytes):
        if zlib.crc32(payload[:-4]) != struct.unpack("<I", payload[-4:])[0]:
            raise CorruptBlock("the checksum of a block's bytes is wrong")
        magic, self.lanes, self.every, self.n, n_words, n_kept = struct.unpack_from(HEADER, payload)
        if magic != MAGIC:
            raise CorruptBlock("not a block")
        entry = np.dtype([("place", "<u4"), ("state", "<u8", (self.lanes,))])
        kept = np.frombuffer(payload, entry, n_kept, struct.calcsize(HEADER))
        self.place, self.state = kept["place"].astype(np.int64), kept["state"].astype(np.uint64)
        self.words = np.frombuffer(payload, "<u4", n_words, struct.calcsize(HEADER) + kept.nbytes)
        self.sum = struct.unpack("<I", payload[-8:-4])[0]
        self.rounds = -(-self.n // self.lanes)

    def lengths(self) -> list[int]:
        """Rounds of each stretch."""
        return [min(self.every, self.rounds - c * self.every) for c in range(len(self.place))]


def decode(blocks: list[Block], model: Model) -> list[np.ndarray]:
    """Ids of blocks with equally many lanes; all stretches side by side, longest first."""
    base = np.cumsum([0, *(len(b.words) for b in blocks)])
    words = np.concatenate([*(b.words for b in blocks), np.zeros(1, np.uint32)]).astype(np.uint64)
    members = [(b, c, n) for b, block in enumerate(blocks) for c, n in enumerate(block.lengths())]
    members.sort(key=lambda m: -m[2])
    state = np.stack([blocks[b].state[c] for b, c, _ in members])
    place = np.array([base[b] + blocks[b].place[c] for b, c, _ in members])
    ids = np.zeros((members[0][2], *state.shape), np.uint32)
    low, at_work = np.uint64((1 << SCALE) - 1), len(members)
    for r in range(members[0][2]):
        while members[at_work - 1][2] <= r:
            at_work -= 1
        now = state[:at_work]
        slot = now & low
        found = model.slots[slot]
        ids[r, :at_work] = found
        now = model.frequency[found] * (now >> np.uint64(SCALE)) + slot - model.start[found]
        empty = now < LOWEST
        order = np.cumsum(empty, axis=1)
        # A lane that is not empty reads nothing; its place may lie one before the words.
        word = words[np.clip(place[:at_work, None] + order - 1, 0, len(words) - 1)]
        state[:at_work] = np.where(empty, (now << np.uint64(32)) | word, now)
        place[:at_work] += order[:, -1]
    parts: list[list[np.ndarray]] = [[None] * len(b.place) for b in blocks]
    for m, (b, c, n) in enumerate(members):
        later = blocks[b].state[c + 1] if c + 1 < len(blocks[b].place) else LOWEST
        if (state[m] != later).any():
            raise CorruptBlock("a stretch does not end where the next one begins")
        parts[b][c] = ids[:n, m].reshape(-1)
    out = []
    for block, own in zip(blocks, parts):
        out.append(np.concatenate(own)[: block.n])
        if zlib.crc32(out[-1].astype("<u4").tobytes()) != block.sum:
            raise CorruptBlock("the checksum of a block's ids is wrong")
    return out


# Writing and reading


def _model(rows: list) -> tuple[np.ndarray, np.ndarray]:
    return np.array([r["id"] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


def write_tokens(tokens: DataFrame, kind: str, path: str) -> None:
    """Write `tokens` (doc_id, key, ids of type `kind`), which must be the same on every read, to
    the folder."""
    spark = tokens.sparkSession
    ids, counts = _model(frequencies(tokens, kind).orderBy("id").collect())
    shares = Model.shares(counts)
    table = pa.table({"id": pa.array(ids), "frequency": pa.array(shares)})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, model = TaskContext.get().partitionId(), Model(ids, shares)
        number = first = 0
        waiting: list[tuple[np.ndarray, list[dict], bool]] = []
        doc_type = None

        def out() -> pa.RecordBatch:
            nonlocal number, first
            sizes = np.array([len(block) for block, _, _ in waiting])
            pieces = pa.list_(pa.struct([("doc_id", doc_type), ("number", pa.int64()), ("n", pa.int32())]))
            rows = {
                "part": pa.array([part] * len(sizes), pa.int32()),
                "block": pa.array(range(number, number + len(sizes)), pa.int32()),
                "first": pa.array(first + np.cumsum(sizes) - sizes, pa.int64()),
                "n_ids": pa.array(sizes, pa.int32()),
                "whole": pa.array([whole for _, _, whole in waiting], pa.bool_()),
                "payload": pa.array(encode([block for block, _, _ in waiting], model), pa.binary()),
                "pieces": pa.array([names for _, names, _ in waiting], pieces),
            }
            number, first = number + len(sizes), first + int(sizes.sum())
            waiting.clear()
            return pa.record_batch(rows)

        document, filled, texts, names = 0, 0, [], []

        def close() -> None:
            nonlocal filled, texts, names
            if filled:
                waiting.append((np.concatenate(texts), names, True))
                filled, texts, names = 0, [], []

        for batch in batches:
            doc_type = batch.schema.field(0).type
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(data.as_buffer(), kind).astype(np.uint32)
                if filled + len(own) > BLOCK:
                    close()
                if len(own) > BLOCK:
                    for at in range(0, len(own), BLOCK):
                        cut = own[at : at + BLOCK]
                        waiting.append((cut, [{"doc_id": doc_id, "number": document, "n": len(cut)}], False))
                        if len(waiting) >= TOGETHER:
                            yield out()
                else:
                    texts.append(own)
                    names.append({"doc_id": doc_id, "number": document, "n": len(own)})
                    filled += len(own)
                document += 1
                if len(waiting) >= TOGETHER:
                    yield out()
        close()
        if waiting:
            yield out()

    doc_id = tokens.schema["doc_id"].dataType.simpleString()
    schema = (
        "part int, block int, first long, n_ids int, whole boolean, payload binary, "
        f"pieces array<struct<doc_id: {doc_id}, number: long, n: int>>"
    )
    in_order = tokens.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key").select("doc_id", "ids")
    in_order.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document: `start` counts the ids of all documents
    before it, `ids` holds little-endian u4."""
    ids, shares = _model(spark.read.parquet(f"{path}/model").orderBy("id").select("id", "frequency").collect())
    blocks = spark.read.parquet(f"{path}/blocks")
    doc_id = blocks.schema["pieces"].dataType.elementType["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(ids, shares)
        for some in batches:
            for at in range(0, some.num_rows, TOGETHER):
                batch = some.slice(at, TOGETHER)
                for b, block in enumerate(decode([Block(p.as_py()) for p in batch.column(2)], model)):
                    names = batch.column(3)[b].values
                    n = names.field("n").to_numpy()
                    ends = np.cumsum(n, dtype=np.int64)
                    data = block.astype("<u4").tobytes()
                    yield pa.record_batch(
                        {
                            "part": pa.array(np.full(len(n), batch.column(0)[b].as_py()), pa.int32()),
                            "place": pa.array(batch.column(1)[b].as_py() + ends - n, pa.int64()),
                            "doc_id": names.field("doc_id"),
                            "number": names.field("number"),
                            "ids": pa.array([data[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), n.tolist())], pa.binary()),
                        }
                    )

    def pieces(of: DataFrame) -> DataFrame:
        read = of.select("part", "first", "payload", "pieces")
        return read.mapInArrow(run, f"part int, place long, doc_id {doc_id}, number long, ids binary")

    # Only a document longer than a block is put together from several.
    parted = (
        pieces(blocks.where("not whole"))
        .groupBy("part", "number")
        .agg(
            F.min_by("doc_id", "place").alias("doc_id"),
            F.min("place").alias("place"),
            F.sort_array(F.collect_list(F.struct("place", F.hex("ids").alias("ids")))).alias("parts"),
        )
        .select("part", "doc_id", "place", F.unhex(F.array_join("parts.ids", "")).alias("ids"))
    )
    # One row per part, which is a task's output.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.groupBy("part")
        .agg(F.sum(F.col("n_ids").cast("long")).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    return (
        pieces(blocks.where("whole"))
        .drop("number")
        .unionByName(parted)
        .join(F.broadcast(starts), "part")
        .select(
            "doc_id",
            (F.col("before") + F.col("place")).alias("start"),
            (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
            "ids",
        )
    )


def encode_corpus(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END, signs: str = SIGNS) -> None:
    """Tokenise all of `docs` and write them to `path`."""
    tokens, kind = tokenized(docs, tokenizer_path, end_id, signs)
    write_tokens(freeze(tokens, "tokens"), kind, path)
