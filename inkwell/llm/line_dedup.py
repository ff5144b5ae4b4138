"""Line deduplication by an exact set-similarity join of the lines' token sets.

Two lines match if the Jaccard similarity of their sets of words is at least `similar`; a line
that matches an earlier one (by id of the document, then place in it) goes. Lines without a
word are left alone. Tokens are compared by hashes of 44 bits: 20 that place them in the order
of rarity (the counts of 2**20 cells over all lines, so every token of the corpus counts and
the order has a fixed size) and 24 more. Two different words of the same 44 bits count as one: of a line's
n words against another's m, with a chance of about n * m / 2**44, so that of lines of 20 words one
comparison in 4 * 10**10 is affected at all, and few of these change sides.

1. Each line becomes the set of its tokens, rarest first, with a hash; equal sets are one.
2. Prefix filter: similar sets share one of the n - ceil(similar * n) + 1 rarest tokens of each. Sets
   are sorted by token and size, so a set meets the sets of fitting size with this token. Such
   pairs are judged in vectors, without becoming rows: by size, by the places of the token
   (what can still follow must suffice), by the token before it (if it is the same in both, the
   pair is found there), and by 128-bit parity maps of the sets, whose difference is never larger
   than that of the sets.
3. A token with more than HOT sets is cut into blocks of about BLOCK sets; each two blocks, and each
   block with itself, are a cell, judged on its own. So no task holds more than a cell or HOT sets.
4. Sets that pass with anyone get their tokens back, meet again in the same cells, and are
   compared exactly. A pair counts under its rarest common token only. Out come the number of
   links of each set and whether an earlier set matches it, not the pairs, whose number grows
   with the square of a group of near copies.

Cases: NULL text is empty; rows that repeat id and text are one document, and each gets its
result; a NULL id comes after all others; of equal lines the first stays; an empty table gives
no rows. Other columns are ignored by `similar_lines` and kept by `remove_lines`.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import packed
from inkwell.llm.features import long_word_hashes, mixed, pieces, whole_groups
from inkwell.llm.sketch import count_cells
from inkwell.sources.scratch import freeze

SIMILAR = 0.8
CELL_BITS, REST_BITS = 20, 24
TOKEN_BITS = CELL_BITS + REST_BITS
RUN = 1 << (64 - TOKEN_BITS)  # lines
SIZE_BITS = 15
LONG = (1 << SIZE_BITS) - 1  # sizes from here on are written as this
PAIRS = 1 << 20  # judged at once
HOT, BLOCK = 1 << 17, 1 << 15  # sets of one token in one task, and in a block of a token with more
NARROW = (2, 16)  # words of 64 tokens in the bit maps of small and of larger groups
SMALL = 500_000  # rows of (document, places) that may be broadcast, of some 50 bytes each


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def parity_maps(tokens: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two times 64 bits for each set of tokens."""
    spread = mixed(tokens)
    bit, low = np.uint64(1) << (spread & np.uint64(63)), (spread >> np.uint64(63)).astype(bool)
    return [np.bitwise_xor.reduceat(np.where(half, bit, np.uint64(0)), first) for half in (low, ~low)]


class Lines:
    """Token sets of all lines with a word in a piece of texts; rarity: the rank of each cell."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rarity: np.ndarray):
        hashes, owner, starts = long_word_hashes(data, offsets)
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        line = breaks[starts] + owner  # one more at each line break and each text
        token = rarity[_cells(hashes)].astype(np.uint64) << np.uint64(REST_BITS) | (
            hashes & np.uint64((1 << REST_BITS) - 1)
        )
        begins = np.r_[True, line[1:] != line[:-1]] if len(line) else np.zeros(0, bool)
        one, number = np.flatnonzero(begins), np.cumsum(begins) - 1
        # Lines with a word are numbered anew; a run of them has numbers that fit above a token.
        of, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for k in range(0, len(one), RUN):
            at = slice(one[k], one[k + RUN] if k + RUN < len(one) else len(line))
            key = np.unique((number[at] - k).astype(np.uint64) << np.uint64(TOKEN_BITS) | token[at])
            of.append((key >> np.uint64(TOKEN_BITS)).astype(np.int64) + k)
            tokens.append(key & np.uint64((1 << TOKEN_BITS) - 1))
        of, self.tokens = np.concatenate(of), np.concatenate(tokens)
        self.first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
        self.size = np.diff(np.r_[self.first, len(of)])
        self.text = owner[one]
        self.place = (line[one] - owner[one] - breaks[offsets[:-1]][owner[one]]).astype(np.int32)
        if len(of):
            self.hash = np.add.reduceat(mixed(mixed(self.tokens) + np.uint64(1)), self.first)
            self.maps = parity_maps(self.tokens, self.first)
        else:
            self.hash, self.maps = np.zeros(0, np.uint64), [np.zeros(0, np.uint64)] * 2


def _least_overlap(n: np.ndarray, m: np.ndarray, similar: float) -> np.ndarray:
    return np.ceil(similar / (1 + similar) * (n + m) - 1e-9).astype(np.int64)


def _line_rows(docs: DataFrame, rarity: np.ndarray, similar: float) -> DataFrame:
    """Per text one row (doc_id, hash, n); per line (doc_id, hash, place, set, map_a); per set, once a
    piece, (set, map_a, map_b, size, prefix: its rarest tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"set": pa.int64(), "map_a": pa.int64(), "map_b": pa.int64(), "place": pa.int32(), "n": pa.int32(),
                 "size": pa.int32(), "prefix": pa.list_(pa.int64())}

        def rows(count, ids, hashes, **columns):
            arrays = {"doc_id": ids, "hash": hashes}
            for name, kind in kinds.items():
                arrays[name] = pa.array(columns[name], kind) if name in columns else pa.nulls(count, kind)
            return pa.record_batch(arrays)

        for batch in batches:
            first = 0
            for data, offsets in pieces(batch.column(2)):
                n = len(offsets) - 1
                ids, hashes = batch.column(0).slice(first, n), batch.column(1).slice(first, n)
                first += n
                lines = Lines(data, offsets, rarity)
                yield rows(n, ids, hashes, n=np.bincount(lines.text, minlength=n))
                if not len(lines.size):
                    continue
                of = pa.array(lines.text)
                signed = [x.astype(np.int64) for x in (lines.hash, *lines.maps)]
                yield rows(
                    len(of), ids.take(of), hashes.take(of), place=lines.place, set=signed[0], map_a=signed[1]
                )
                _, once = np.unique(lines.hash, return_index=True)
                size = lines.size[once]
                prefix = size - np.ceil(similar * size - 1e-9).astype(np.int64) + 1
                ends = np.cumsum(prefix)
                at = np.repeat(lines.first[once] - (ends - prefix), prefix) + np.arange(ends[-1])
                yield rows(
                    len(once),
                    pa.nulls(len(once), ids.type),
                    pa.nulls(len(once), pa.int64()),
                    set=signed[0][once],
                    map_a=signed[1][once],
                    map_b=signed[2][once],
                    size=size,
                    prefix=pa.ListArray.from_arrays(
                        pa.array(np.r_[0, ends], pa.int32()), pa.array(lines.tokens[at].astype(np.int64))
                    ),
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, hash long, set long, map_a long, map_b long, place int, n int, size int, prefix array<long>"
    )
    return docs.select("doc_id", "hash", "text").mapInArrow(run, schema)


def _postings(stored: DataFrame) -> DataFrame:
    """Per token of a prefix (key: token and size, at: the token before and the place, set, map_a, map_b)."""
    sets = stored.where(F.col("size").isNotNull())
    each = sets.select("set", "map_a", "map_b", "size", "prefix", F.posexplode("prefix").alias("place", "token"))
    before = F.when(F.col("place") > 0, F.element_at("prefix", F.col("place"))).otherwise(0)
    # A place beyond 2**16 is given as the last one, which only lets more pairs pass.
    return each.select(
        F.shiftleft("token", SIZE_BITS).bitwiseOR(F.least("size", F.lit(LONG)).cast("long")).alias("key"),
        F.shiftleft(before, 16).bitwiseOR(F.least("place", F.lit(0xFFFF)).cast("long")).alias("at"),
        "set",
        "map_a",
        "map_b",
    )


def _stops(group: np.ndarray, size: np.ndarray, similar: float, cut: int) -> np.ndarray:
    """For rows sorted by group and size: where the rows of fitting size behind each end."""
    most = np.where(size >= cut, cut, np.minimum(np.floor(size / similar + 1e-9).astype(np.int64), cut))
    return np.searchsorted(group << 32 | size, group << 32 | most, side="right")


def _pairs(
    group: np.ndarray, size: np.ndarray, side: np.ndarray, similar: float, cut: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of fitting size, about PAIRS at a time; where sides are given, of different ones."""
    number = _stops(group, size, similar, cut) - np.arange(len(size)) - 1
    upto = np.cumsum(number)
    first = 0
    while first < len(size):
        done = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + PAIRS, side="right")))
        count = number[first:last]
        i = np.repeat(np.arange(first, last), count)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        if side[first:last].any():
            apart = (side[i] == 0) | (side[i] != side[j])
            i, j = i[apart], j[apart]
        if len(i):
            yield i, j
        first = last


def _passing(group, size, at, maps, side, similar: float) -> np.ndarray:
    """Which rows pass the filters with another row of their group."""
    place, before = at & 0xFFFF, at >> 16
    maps = [x.view(np.uint64) for x in maps]  # else bits of the absolute value count
    passed = np.zeros(len(size), dtype=bool)
    for i, j in _pairs(group, size, side, similar, LONG):
        n, m = size[i], size[j]
        need = _least_overlap(n, m, similar)
        apart = sum(np.bitwise_count(x[i] ^ x[j]).astype(np.int64) for x in maps)
        fits = (np.minimum(n - place[i], m - place[j]) >= need) & (apart <= n + m - 2 * need)
        fits |= (n == LONG) | (m == LONG)  # sizes cut off: leave it to the exact step
        fits &= (before[i] != before[j]) | (place[i] == 0) | (place[j] == 0)
        passed[i[fits]] = True
        passed[j[fits]] = True
    return passed


def _by_token(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Table, bool]]:
    """Rows sorted by key, cut only where the token changes; the rows of a token with more than
    `most` come in pieces, which are marked."""
    waiting, token, hot = [], None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        tokens = batch.column(0).to_numpy() >> SIZE_BITS
        if hot:
            more = int(np.searchsorted(tokens, token, side="right"))
            if more:
                yield pa.Table.from_batches([batch.slice(0, more)]), True
            if more == len(tokens):
                continue
            batch, tokens, hot = batch.slice(more), tokens[more:], False
        last = int(np.searchsorted(tokens, tokens[-1], side="left"))
        if last or (waiting and token != tokens[0]):
            yield pa.Table.from_batches([*waiting, batch.slice(0, last)]), False
            waiting = []
        waiting.append(batch.slice(last))
        token = tokens[-1]
        if sum(x.num_rows for x in waiting) > most:
            yield pa.Table.from_batches(waiting), True
            waiting, hot = [], True
    if waiting:
        yield pa.Table.from_batches(waiting), False


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns changes, the first row included."""
    return np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])][: len(columns[0])]


CELL = "cell long, part long, token long, side int, set long, map_a long"


def _candidates(postings: DataFrame, similar: float, hot: int, block: int) -> DataFrame:
    """(cell, part, token, side, set, map_a) of the sets that pass the filters with another set of the
    cell. A token that isn't hot is one cell; sides are 0 where all pairs of a cell count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(count, **columns):
            names = ["cell", "part", "token", "side", "set", "map_a", "map_b", "key", "at"]
            kinds = [pa.int32() if name == "side" else pa.int64() for name in names]
            return pa.record_batch(
                [pa.array(columns[n], k) if n in columns else pa.nulls(count, k) for n, k in zip(names, kinds)],
                names=names,
            )

        for table, many in _by_token(batches, hot):
            key, at, name, map_a, map_b = (c.to_numpy() for c in table.columns)
            if many:
                yield rows(len(key), set=name, map_a=map_a, map_b=map_b, key=key, at=at)
                continue
            # Most rows have no other row of fitting size under their token.
            here, group = np.arange(len(key)), np.cumsum(_starts(key >> SIZE_BITS))
            stop = _stops(group, key & LONG, similar, LONG)
            met = np.flatnonzero((stop > here + 1) | (np.r_[0, np.maximum.accumulate(stop)[:-1]] > here))
            met = met[np.lexsort((map_a[met], name[met], key[met]))]
            met = met[_starts(key[met], name[met], map_a[met])]
            key, at, name, map_a, map_b = (x[met] for x in (key, at, name, map_a, map_b))
            token, none = key >> SIZE_BITS, np.zeros(len(key), np.int32)
            passed = _passing(np.cumsum(_starts(token)), key & LONG, at, (map_a, map_b), none, similar)
            token, none = token[passed], none[passed]
            yield rows(
                len(token), cell=token, part=none - 1, token=token, side=none, set=name[passed], map_a=map_a[passed]
            )

    def run_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            cell, part, key, at, name, map_a, map_b, side = (c.to_numpy() for c in table.columns)
            token = key >> SIZE_BITS
            group = np.cumsum(_starts(cell, part, token))
            passed = _passing(group, key & LONG, at, (map_a, map_b), side, similar)
            yield pa.record_batch(
                [pa.array(x[passed]) for x in (cell, part, token, side, name, map_a)],
                names=["cell", "part", "token", "side", "set", "map_a"],
            )

    token = F.shiftright("key", SIZE_BITS)
    dealt = postings.repartition(token).sortWithinPartitions("key")
    judged = freeze(dealt.mapInArrow(run, f"{CELL}, map_b long, key long, at long"), "judged")
    passed = judged.where(F.col("key").isNull()).drop("map_b", "key", "at")
    left = judged.where(F.col("key").isNotNull()).select("key", "at", "set", "map_a", "map_b").distinct()
    left = freeze(left.withColumn("token", token), "hot")
    counts = freeze(
        left.groupBy("token").agg(F.ceil(F.count("*") / block).alias("blocks")).withColumnRenamed("token", "_token"),
        "blocks",
    )
    number = counts.count()
    if not number:
        return passed
    if number <= SMALL:
        counts = F.broadcast(counts)
    mine = F.pmod(F.xxhash64("set", "map_a"), F.col("blocks"))
    cells = (
        left.join(counts, F.col("token") == F.col("_token"))
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("part", F.shiftleft(F.least("mine", "other"), 32) + F.greatest("mine", "other"))
        .withColumn(
            "side", F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
        )
        .withColumn("cell", F.xxhash64("token", "part"))
        .select("cell", "part", "key", "at", "set", "map_a", "map_b", "side")
    )
    cells = cells.repartition("cell").sortWithinPartitions("cell", "part", "key")
    return passed.unionByName(cells.mapInArrow(run_cells, CELL))


def _token_sets(docs: DataFrame, rarity: np.ndarray) -> DataFrame:
    """(set, map_a, tokens) of the lines at `places` of docs (text, places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for data, offsets in pieces(batch.column(0)):
                n = len(offsets) - 1
                lines = Lines(data, offsets, rarity)
                wanted = batch.column(1).slice(first, n)
                count = wanted.value_lengths().to_numpy(zero_copy_only=False)
                chosen = np.flatnonzero(
                    np.isin(
                        lines.text << 32 | lines.place,
                        np.repeat(np.arange(n), count) << 32 | wanted.flatten().to_numpy(),
                    )
                )
                cut = [lines.tokens[lines.first[x] : lines.first[x] + lines.size[x]] for x in chosen]
                yield pa.record_batch(
                    [
                        pa.array(lines.hash[chosen].astype(np.int64)),
                        pa.array(lines.maps[0][chosen].astype(np.int64)),
                        pa.array([c.astype("<u8").tobytes() for c in cut], pa.binary()),
                    ],
                    names=["set", "map_a", "tokens"],
                )
                first += n

    return docs.select("text", "places").mapInArrow(run, "set long, map_a long, tokens binary")


class Sets:
    """Token sets of some rows, grouped and sorted by size, whose pairs are compared exactly."""

    def __init__(self, group: np.ndarray, token: np.ndarray, tokens: np.ndarray, size: np.ndarray):
        self.group, self.token, self.tokens, self.size = group, token.astype(np.uint64), tokens, size
        self.first = np.cumsum(size) - size
        self.row = np.repeat(np.arange(len(size)), size)
        rarer = tokens < self.token[self.row]
        self.place = np.add.reduceat(rarer.astype(np.int64), self.first)
        self.maps = parity_maps(tokens, self.first)
        # Tokens that two sets of a group share, numbered from 0 in each group, rarest first.
        order = np.lexsort((tokens, group[self.row]))
        of, name = group[self.row][order], tokens[order]
        begins = _starts(of, name)
        number = np.cumsum(begins) - 1
        shared = np.bincount(number) > 1
        rank = np.cumsum(shared) - 1
        heads = np.flatnonzero(begins)
        least = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, of[heads][shared], rank[shared])
        width = np.zeros(len(least), np.int64)
        np.add.at(width, of[heads][shared], 1)
        self.id = np.full(len(tokens), -1, np.int64)
        self.id[order] = np.where(shared[number], rank[number] - least[of], -1)
        self.words = -(-width // 64)
        self.rarer = rarer

    def overlaps(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens each pair shares, and whether one of them is rarer than the group's."""
        overlap, rarer = np.zeros(len(i), np.int64), np.zeros(len(i), dtype=bool)
        words = self.words[self.group[i]]
        for over, upto in zip((-1, *NARROW), NARROW):
            at = np.flatnonzero((words > over) & (words <= upto))
            if len(at):
                full, before = self._bits(over, upto)
                for k in range(upto):
                    both = full[k][i[at]] & full[k][j[at]]
                    overlap[at] += np.bitwise_count(both)
                    rarer[at] |= (both & before[k][i[at]]) != 0
        wide = np.flatnonzero(words > NARROW[-1])
        upto = np.cumsum(self.size[i[wide]])
        first = 0
        while first < len(wide):
            done = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, done + PAIRS, side="right")))
            at = wide[first:last]
            overlap[at], rarer[at] = self._looked_up(i[at], j[at])
            first = last
        return overlap, rarer

    def _bits(self, over: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
        """Bit maps of all tokens, and of those rarer than the group's, of the groups of a width."""
        cached = self.__dict__.setdefault("_maps", {})
        if upto not in cached:
            words = self.words[self.group]
            fits = (words > over) & (words <= upto)
            use = np.flatnonzero((self.id >= 0) & fits[self.row])
            slot = self.row[use] * upto + (self.id[use] >> 6)
            bit = np.uint64(1) << (self.id[use] & 63).astype(np.uint64)
            found = []
            for bits in (bit, np.where(self.rarer[use], bit, np.uint64(0))):
                flat = np.zeros(len(self.size) * upto, np.uint64)
                starts = np.flatnonzero(_starts(slot))
                if len(starts):
                    flat[slot[starts]] = np.bitwise_or.reduceat(bits, starts)
                found.append(np.ascontiguousarray(flat.reshape(-1, upto).T))
            cached[upto] = found
        return cached[upto]

    def _looked_up(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same by looking up each token of i in j: rows in runs of RUN fit above a token."""
        n = self.size[i]
        at = np.repeat(self.first[i] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        name, owner = self.tokens[at], np.repeat(j, n)
        common = np.zeros(len(at), dtype=bool)
        for k in range(0, len(self.size), RUN):
            last = min(k + RUN, len(self.size))
            keep = slice(self.first[k], self.first[last - 1] + self.size[last - 1])
            keys = (self.row[keep] - k).astype(np.uint64) << np.uint64(TOKEN_BITS) | self.tokens[keep]
            here = np.flatnonzero((owner >= k) & (owner < last))
            want = (owner[here] - k).astype(np.uint64) << np.uint64(TOKEN_BITS) | name[here]
            found = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            common[here] = keys[found] == want
        starts = np.cumsum(n) - n
        return np.add.reduceat(common.astype(np.int64), starts), np.logical_or.reduceat(common & self.rarer[at], starts)

    def matches(self, side: np.ndarray, similar: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j) of similar sets whose rarest common token is that of their group."""
        for i, j in _pairs(self.group, self.size, side, similar, 1 << 31):
            n, m = self.size[i], self.size[j]
            need = _least_overlap(n, m, similar)
            apart = sum(np.bitwise_count(x[i] ^ x[j]).astype(np.int64) for x in self.maps)
            fits = (np.minimum(n - self.place[i], m - self.place[j]) >= need) & (apart <= n + m - 2 * need)
            i, j, need = i[fits], j[fits], need[fits]
            overlap, rarer = self.overlaps(i, j)
            same = (overlap >= need) & ~rarer
            yield i[same], j[same]


def _verified(members: DataFrame, similar: float) -> DataFrame:
    """From CELL, tokens and rank: links of each set in each cell, and whether a set of a lower rank is
    among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches):
            cell, part, token, side, name, map_a = (rows.column(c).to_numpy() for c in range(6))
            rank = pa.Table.from_arrays(pa.concat_arrays(rows.column(7).chunks).flatten(), names=list("abcd"))
            place = np.empty(len(cell), dtype=np.int64)
            # NULL ids have their flag set, so the values behind it are never compared with others.
            place[pc.sort_indices(rank, sort_keys=[(c, "ascending") for c in "abcd"]).to_numpy()] = np.arange(len(cell))
            packs = pa.concat_arrays(rows.column(6).chunks).cast(pa.large_binary())
            offsets = np.frombuffer(packs.buffers()[1], np.int64)[packs.offset : packs.offset + len(packs) + 1]
            tokens = np.frombuffer(packs.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view("<u8")
            first, size = (offsets[:-1] - offsets[0]) // 8, np.diff(offsets) // 8
            group = np.cumsum(_starts(cell, part, token)) - 1
            order = np.lexsort((size, group))
            n = size[order].astype(np.int64)
            at = np.repeat(first[order] - (np.cumsum(n) - n), n) + np.arange(len(tokens))
            sets = Sets(group[order], token[order], tokens[at], n)
            links, later, place = np.zeros(len(cell), np.int64), np.zeros(len(cell), dtype=bool), place[order]
            for i, j in sets.matches(side[order], similar):
                links += np.bincount(i, minlength=len(cell)) + np.bincount(j, minlength=len(cell))
                later[np.where(place[i] > place[j], i, j)] = True
            found = links > 0
            yield pa.record_batch(
                [pa.array(x[found]) for x in (name[order], map_a[order], links, later)],
                names=["set", "map_a", "links", "later"],
            )

    dealt = members.repartition("cell").sortWithinPartitions("cell", "part", "token")
    names = ["cell", "part", "token", "side", "set", "map_a", "tokens", "rank"]
    return dealt.select(*names).mapInArrow(run, "set long, map_a long, links long, later boolean")


def similar_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similar: float = SIMILAR,
    hot: int = HOT,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, hash (of the text), n_lines (with a word), removed (places of
    the lines that match an earlier one, from 0), n_links (sum over its lines of the other token
    sets that match), n_copies (its lines that have copies)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    counts, _ = count_cells(rows, CELL_BITS, lambda data, offsets: _cells(long_word_hashes(data, offsets)[0]))
    rarity = np.empty(len(counts), dtype=np.uint32)
    rarity[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint32)

    stored = freeze(_line_rows(rows, rarity, similar), "lines")
    lines = stored.where(F.col("place").isNotNull()).select("doc_id", "hash", "place", "set", "map_a")
    passed = freeze(_candidates(_postings(stored), similar, hot, block), "candidates")

    # Where each set is found first.
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "place")
    sets = freeze(
        lines.groupBy("set", "map_a").agg(F.min(place).alias("rank"), F.count("*").alias("n_lines")), "sets"
    )
    named = passed.select("set", "map_a").distinct().join(sets, ["set", "map_a"])
    named = freeze(named.select("set", "map_a", "rank", "rank.doc_id", "rank.hash", "rank.place"), "named")
    wanted = named.groupBy("doc_id", "hash").agg(F.collect_set("place").alias("places"))
    wanted = wanted.withColumnsRenamed({"doc_id": "_doc", "hash": "_hash"})
    if named.count() <= SMALL:
        wanted = F.broadcast(wanted)
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("hash") == F.col("_hash"))
    tokens = _token_sets(rows.join(wanted, same), rarity).groupBy("set", "map_a").agg(F.first("tokens").alias("tokens"))
    members = passed.join(named.select("set", "map_a", "rank").join(tokens, ["set", "map_a"]), ["set", "map_a"])
    verified = freeze(_verified(members, similar), "links")
    links = verified.groupBy("set", "map_a").agg(F.sum("links").alias("links"), F.max("later").alias("later"))

    # Sets that occur once and match nothing need no join.
    told = (
        sets.join(links, ["set", "map_a"], "left")
        .where((F.col("n_lines") > 1) | F.col("links").isNotNull())
        .withColumnRenamed("n_lines", "copies")
    )
    judged = lines.join(told, ["set", "map_a"]).select(
        "doc_id",
        "hash",
        "place",
        F.coalesce("links", F.lit(0)).alias("links"),
        (F.col("copies") > 1).alias("copied"),
        (F.coalesce("later", F.lit(False)) | (place != F.col("rank"))).alias("goes"),
    ).distinct()
    verdicts = judged.groupBy("doc_id", "hash").agg(
        F.sort_array(F.collect_list(F.when(F.col("goes"), F.col("place")))).alias("removed"),
        F.sum("links").alias("n_links"),
        F.count_if("copied").alias("n_copies"),
    ).withColumnsRenamed({"doc_id": "_doc", "hash": "_hash"})
    texts = stored.where(F.col("n").isNotNull()).select("doc_id", "hash", F.col("n").cast("long").alias("n_lines"))
    return texts.join(verdicts, same, "left").select(
        "doc_id",
        "hash",
        "n_lines",
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(0)).cast("long").alias("n_copies"),
    )


def remove_lines(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the lines that go; a document that loses all its lines with a word goes."""
    text = F.col("row")[text_col]
    told = verdicts.select("doc_id", "hash", "n_lines", "removed").distinct()
    same = F.col("row")[id_col].eqNullSafe(F.col("doc_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("hash"))
    left = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col("removed"), i))
    cut = F.when(F.size("removed") > 0, F.array_join(left, "\n")).otherwise(text).alias(text_col)
    stays = (F.col("n_lines") == 0) | (F.size("removed") < F.col("n_lines"))
    found = docs.select(packed(docs)).join(told, same).where(stays)
    return found.select(*(cut if name == text_col else F.col("row")[name].alias(name) for name in docs.columns))
