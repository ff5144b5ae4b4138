"""Token files, spelling variants and importance resampling: round trips, brute force, odd rows."""

import json
import math
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from inkwell.llm import importance, spelling, token_file
from inkwell.llm.features import pieces
from inkwell.sources.scratch import freeze, scratch_path

SF_DIR = "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, key string, row long, part int, word string, n long, ids string, score int"
LONG = "Ünïted tëxt, 3 words'll <|endoftext|>\tdo it " * 9000
ODD = [
    (1, "The cat's  cat\n\nsat on the mät", "x", 1, 1, "w", 1, "i", 1),
    (1, "The cat's  cat\n\nsat on the mät", "x", 1, 1, "w", 1, "i", 1),
    (1, "another text of the same id", None, None, None, None, None, None, None),
    (None, "a text without an id, letters lettors letters", None, None, None, None, None, None, None),
    (2, None, "", 0, 0, "", 0, "", 0),
    (3, "", "", 0, 0, "", 0, "", 0),
    (4, " \t\r\n ", "", 0, 0, "", 0, "", 0),
    (5, LONG, "", 0, 0, "", 0, "", 0),
    (6, "x" * 70_000, "", 0, 0, "", 0, "", 0),
]


def odd(spark, rows=ODD):
    return spark.createDataFrame(rows, SCHEMA)


# Token files


def read_back(spark, docs, **settings):
    folder = scratch_path(spark, "test-tokens")
    token_file.encode_corpus(docs, TOKENIZER, folder, **settings)
    return folder, token_file.read_tokens(spark, folder)


def tokens_of(texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [[*done.ids, 1] for done in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_tokens_round_trip(spark, monkeypatch):
    """Small blocks, so that documents lie in many, and small stretches of text."""
    monkeypatch.setattr(token_file, "BLOCK", 1000)
    monkeypatch.setattr(token_file, "CHECKPOINT", 7)
    monkeypatch.setattr(token_file, "STRETCH", 5000)
    docs = odd(spark)
    folder, read = read_back(spark, docs)
    rows = sorted(((r.doc_id is not None, r.doc_id, sha256(b"").digest(), r.text or "") for r in docs.collect()), key=str)
    wanted = Counter((i, tuple(ids)) for (_, i, _, _), ids in zip(rows, tokens_of([t for *_, t in rows])))
    got = read.collect()
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == wanted
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0, *(r.n_tokens for r in in_order)])[:-1].tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in in_order]
    assert ids == sorted(ids)
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.where("not whole").count() > 10
    assert blocks.where("n_ids > 1000").isEmpty()


def test_tokens_of_an_empty_table(spark):
    folder, read = read_back(spark, odd(spark, []))
    assert read.columns == ["doc_id", "start", "n_tokens", "ids"] and read.count() == 0


def test_tokens_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    folder, read = read_back(spark, docs)
    rows = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in read.collect()}
    assert got == {i: ids for (i, _), ids in zip(rows, tokens_of([t for _, t in rows]))}
    size = spark.read.parquet(f"{folder}/blocks").agg(F.sum(F.octet_length("payload"))).first()[0]
    n = Counter(x for ids in got.values() for x in ids)
    total = sum(n.values())
    entropy = sum(c * math.log2(total / c) for c in n.values()) / 8
    assert entropy < size < 1.05 * entropy


def test_each_piece_is_learned_once_whatever_its_case():
    settings = open(TOKENIZER, encoding="utf-8").read()
    encoder = token_file.Encoder(settings, token_file.SIGNS, token_file.lower_cases(settings))
    texts = ["The cat. THE Cat!", "", "the\tCAT,\ncat", "été. Été! été"]
    for data, offsets in pieces(pa.array(texts), 1 << 20):
        ids, bounds = encoder(data, offsets)
    assert [[*ids[a:b], 1] for a, b in zip(bounds, bounds[1:])] == tokens_of(texts)
    assert set(encoder.known) == {"the", "cat", ".", "!", ",", "été", "Été"}


def test_folding_only_for_a_tokenizer_that_folds():
    settings = json.loads(open(TOKENIZER, encoding="utf-8").read())
    assert token_file.lower_cases(json.dumps(settings))
    first = {"type": "Replace", "pattern": {"String": "A"}, "content": "x"}
    for normalizer in (None, {"type": "NFC"}, {"type": "Sequence", "normalizers": [first, {"type": "Lowercase"}]}):
        assert not token_file.lower_cases(json.dumps({**settings, "normalizer": normalizer}))
    assert token_file.lower_cases(json.dumps({**settings, "normalizer": {"type": "Lowercase"}}))


@pytest.mark.parametrize("stretch", [30, 1 << 20])
def test_tokens_of_odd_signs(spark, monkeypatch, stretch):
    """Case before combining marks, signs behind letters of all kinds, upper-case added tokens, white space
    that parts no pieces."""
    monkeypatch.setattr(token_file, "STRETCH", stretch)
    words = ["J\u030c", "j\u030c", "J", "Å", "A\u030a", "\u212a.", "\u0130!", "ΣΑΣ.", "×.", "÷,", "é;", "É;", "—.", "…!", "x\u0301."]
    words += ["<|ENDOFTEXT|>", "a<|EndOfText|>.", "<|endoftext|>!", "a\x0bB.", "\x0b", "A\u00a0B!", "\u3000", "\u1112\u1161\u11ab.", "한.", "🙂!", "🙂\u200d!"]
    words += ["DON'T.", "'S", "'s'", "dogs'", "X2.", "2.X", "...", "a.b.", "a!!!!!!!!", "a!!!!!!!!!", "a\u0301!!!!!!!!!.", "!!!!!!!!!!", "\u0308a", "\u00aa.", "\u01c5.", "\ufb01.", "\x00A", "\x7f."]
    texts = [*words, " ".join(words), " ".join(words[::-1]), *("".join(words[k : k + 3]) for k in range(len(words)))]
    texts += [f"{w}\n\n{v}" for w in words[:15] for v in words]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for signs in (token_file.SIGNS, token_file.SIGNS + "…×", ""):
        folder, read = read_back(spark, docs, signs=signs)
        got = [np.frombuffer(r.ids, "<u4").tolist() for r in read.orderBy("doc_id").collect()]
        assert got == tokens_of(texts)


def model_of(*arrays):
    ids, counts = np.unique(np.concatenate(arrays), return_counts=True)
    return token_file.Model(ids, token_file.Model.shares(counts))


@pytest.mark.parametrize("n", [1, 31, 32, 33, 512 * 32, 512 * 32 + 1, 40_000])
@pytest.mark.parametrize("kinds", [1, 2, 3000])
def test_blocks_round_trip(n, kinds):
    random = np.random.default_rng(n + kinds)
    blocks = [random.geometric(1 / kinds, n).astype(np.uint32) for _ in range(3)]
    model = model_of(*blocks)
    assert model.frequency.sum() == 1 << token_file.SCALE and len(model.slots) == 1 << token_file.SCALE
    payloads = token_file.encode(blocks, model)
    parsed = [token_file.Block(p) for p in payloads]
    assert all(len(b.place) == -(-b.rounds // token_file.CHECKPOINT) for b in parsed)
    assert all((a == b).all() for a, b in zip(blocks, token_file.decode(parsed, model)))


def test_damage_is_noticed():
    ids = np.arange(70_000, dtype=np.uint32) % 777
    model = model_of(ids)
    payload = token_file.encode([ids], model)[0]
    for at in (9, 40, len(payload) // 2, len(payload) - 6, len(payload) - 1):
        broken = bytearray(payload)
        broken[at] ^= 4
        with pytest.raises(token_file.CorruptBlock):
            token_file.Block(bytes(broken))
    # A sound block that is read with another table.
    with pytest.raises(token_file.CorruptBlock):
        token_file.decode([token_file.Block(payload)], model_of(ids[:500], np.arange(777, dtype=np.uint32)))


def test_a_stretch_is_read_from_its_checkpoint():
    """The second stretch alone, without the words of the first."""
    ids = (np.arange(40_000, dtype=np.uint32) ** 2) % 991
    model = model_of(ids)
    block = token_file.Block(token_file.encode([ids], model)[0])
    first = token_file.CHECKPOINT * token_file.LANES
    block.words = np.concatenate([np.zeros(block.place[1], np.uint32), block.words[block.place[1] :]])
    block.place, block.state, block.rounds = block.place[1:], block.state[1:], block.rounds - token_file.CHECKPOINT
    block.n -= first
    block.sum = crc32(ids[first:].astype("<u4").tobytes())
    assert (token_file.decode([block], model)[0] == ids[first:]).all()


# Spelling variants


def variants(texts):
    """The same by trying every word that one change makes."""
    counts = Counter()
    for doc, text in texts:
        for run in spelling_runs(text or ""):
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near, patterns = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            less = w[:i] + w[i + 1 :]
            patterns[i, less].add(w)
            if less in words:
                near[w].add(less)
                near[less].add(w)
    for group in patterns.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items()}


def spelling_runs(text):
    run = ""
    for c in text + " ":
        if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
            run += c.lower() if c < "\x80" else c
        elif run:
            yield run
            run = ""


def found_variants(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_variants_of_made_words(spark):
    """Doubled letters, repeated bigrams, ties, chains of forms, words at their least length."""
    base = ["banana", "bananas", "bananana", "aaaaa", "aaaaaa", "aaaaaaa", "abababab", "babababa", "Ångström", "ångström", "letter", "lettre", "better"]
    base += [f"{a}hose" for a in "tcwl"] + [f"cro{b}ssing" for b in "sabc"] + ["éléphant", "elephant", "éléphants", "four", "fours"]
    texts = [(i, " ".join([w] * (3 + 5 * (k % 7)))) for i, (k, w) in enumerate((k, w) for k in range(9) for w in base[k:])]
    texts += [(100 + i, " ".join(f"{w[:k]}{c}{w[k + 1:]}, " * 3 for k in range(len(w)))) for i, w in enumerate(base) for c in "aé"]
    texts += [(300 + k, f"chain{'b' * k}{'a' * (5 - k)} " * (3 << (5 - k))) for k in range(6)]
    texts += [(None, "banana " * 4), (1, None), (2, ""), (1, texts[1][1]), (1, texts[1][1]), (7, "q" * 40_000 + " " + "q" * 40_001)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    wanted = variants(texts)
    assert len(wanted) > 150 and any(v[4] != v[2] for v in wanted.values() if v[2])
    assert found_variants(spelling.spelling_variants(docs)) == wanted


def test_variants_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    wanted = variants([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert found_variants(spelling.spelling_variants(docs)) == wanted


def test_very_long_words(spark):
    word = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(30_000))
    texts = [(i, f"{w} {w} {w}") for i, w in enumerate([word, word + "x", word[:9999] + word[10_000:], word[:5] + "é" + word[6:], word[::-1]])]
    found = spelling.spelling_variants(spark.createDataFrame(texts, "doc_id long, text string"))
    assert sorted(r.n_near for r in found.collect()) == [0, 1, 1, 1, 3]


@pytest.mark.parametrize("long", [0, 100])
def test_one_change(spark, monkeypatch, long):
    monkeypatch.setattr(spelling, "LONG", long)
    words = ["abcd", "abcde", "abc", "bbcd", "abcé", "abdc", "aabcd", "abccd", "abcd", "éabcd", "bcd", "abcdef", ""]
    pairs = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    for r in pairs.select("a", "b", spelling.one_change("a", "b").alias("near")).collect():
        wanted = r.b in {r.a[:i] + c + r.a[j:] for i in range(len(r.a) + 1) for j in (i, i + 1) for c in ["", *"abcdefé"]}
        assert r.near == (wanted and r.a != r.b), r


def test_pivots_are_the_cheapest_that_dont_overlap():
    random = np.random.default_rng(3)
    place = np.sort(np.array([random.choice(9, 3, replace=False) for _ in range(500)]), axis=1)
    weight = random.integers(1, 6, place.shape)
    for p, w, chosen in zip(place, weight, spelling.pivots(place, weight)):
        fits = {(i, j): w[i] + w[j] for i in range(3) for j in range(i) if p[i] - p[j] >= 2}
        i, j = sorted(chosen, reverse=True)
        assert fits[i, j] == min(fits.values())


def test_odd_rows_of_spelling(spark):
    columns = found_variants(spelling.spelling_variants(odd(spark)))
    assert columns == variants([(r[0], r[1]) for r in ODD])
    assert spelling.spelling_variants(odd(spark, [])).count() == 0


# Importance resampling


def words_of(text):
    folded = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or c > "\x7f" else " " for c in folded).split(" ")


def features(text):
    w = [x for x in words_of(text) if x]
    return len(w), [crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def resampled(docs, target, percent=5, least=20):
    """(doc_id, n_features, weight, score, rank) of all rows, one by one."""
    source = [(i, *features(t), t or "") for i, t in docs]
    s = Counter(b for _, _, f, _ in source for b in f)
    t = Counter(b for text in target for b in features(text)[1])
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10_000) / ((s[b] + 1.0) * (all_t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, n, f, text in source:
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for k, row in enumerate(able[: percent * len(able) // 100]):
        row[4] = k + 1
    return Counter(tuple(r[:5]) for r in rows)


def drawn(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def test_resampling_of_the_given_documents(spark, monkeypatch):
    monkeypatch.setattr(importance, "STRETCH", 300)
    docs, items = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    wanted = resampled([tuple(r) for r in docs.select("doc_id", "text").collect()], [r.text for r in items.collect()])
    assert drawn(importance.resample(docs, items)) == wanted


@pytest.mark.parametrize("n", [0, len(ODD)])
def test_resampling_of_odd_rows(spark, n):
    items = spark.createDataFrame([(1, "The cat"), (2, None)] if n else [], "item_id long, text string")
    rows = [r[:2] for r in ODD[:n]]
    wanted = resampled(rows, ["The cat", None] if n else [], 50, 1)
    found = drawn(importance.resample(odd(spark, ODD[:n]), items, percent=50, least_words=1))
    # The two texts of id 1 are ordered by their hash, so only what is drawn of it is the same.
    assert Counter(r[:4] for r in found.elements()) == Counter(r[:4] for r in wanted.elements())
    assert {r[4] for r in found} == {r[4] for r in wanted}


def test_ties_and_equal_rows_are_drawn_one_by_one(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(7, text)] * 50 + [(8, text)] * 50, "doc_id long, text string")
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    for percent in (3, 50, 53, 100):
        got = importance.resample(docs, items, percent=percent)
        assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(range(1, percent + 1))
        assert got.count() == 100


@pytest.mark.parametrize("pivots", [1, 2, 64])
def test_quickselect(spark, pivots):
    rows = spark.range(500).selectExpr("(id * 7919) % 83 as a", "case when id % 5 > 0 then id % 50 end as b", "id as c")
    keys = sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0], r[1] is not None, r[1], r[2]))
    rows = freeze(rows.repartition(5), "keys")
    order = ["a", "b", "c"]
    for k in (1, 2, 77, 499, 500):
        last = importance.kth(rows, order, k, pivots)
        assert tuple(spark.range(1).select(last.alias("k")).first().k) == keys[k - 1]
        assert rows.where(F.struct(*order) <= last).count() == k
    assert importance.kth(rows, order, 0, pivots) is None
    assert importance.kth(rows, order, 501, pivots) is None
