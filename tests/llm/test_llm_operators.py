"""Operators for training text on small tables: brute force, round trips, odd rows."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, spark_rows, sql_rows
from pyspark.sql import functions as F

import corpus_pipeline
from inkwell.llm import (
    chat,
    decontaminate,
    features,
    line_dedup,
    mixing,
    models,
    near_dedup,
    quality_rank,
    quality_rules,
    secret_scan,
    suffix_dedup,
    toxicity,
)
from inkwell.llm.common import held_out
from inkwell.llm.queries import ORACLES, QUERIES
from inkwell.sources.scratch import freeze

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row long, place int"
ITEMS = "item_id long, text string"
LABELS = "doc_id long, quality int, toxic int"

PASSAGE = "one two three four five six seven eight nine ten eleven twelve " * 12
ODD = [
    (1, PASSAGE, "en", "a", 1, "x", 7, 3),
    (1, PASSAGE, "en", "a", 1, "x", 7, 3),  # repeated row
    (None, PASSAGE, None, None, None, None, None, None),
    (2, None, None, None, None, None, None, None),
    (3, "", "en", "b", 0, "", 0, 0),
    (4, "  \n\t \n", "en", "b", 6, "", 0, 0),
    (5, "word " * 30_000, "en", "b", 150_000, "", 0, 0),
    (6, "alpha beta gamma delta\nalpha beta gamma delta\nalpha beta gamma delta epsilon", "en", "c", 0, "", 0, 0),
    (7, "<s>[INST] \\ é password = hunter2xyz", "en", "c", 0, "", 0, 0),
]


def odd(spark, rows=ODD):
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, con, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == sql_rows(con, ORACLES[name])


def test_lines_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 150")
    lines = [
        (r.doc_id, k, frozenset(line.encode().split()))
        for r in docs.collect()
        for k, line in enumerate((r.text or "").split("\n"))
        if line.split()
    ]
    first = {}
    for doc, k, s in sorted(lines, key=lambda x: x[:2]):
        first.setdefault(s, (doc, k))
    sets, links, later = list(first), Counter(), set()
    for i, a in enumerate(sets):
        for b in sets[:i]:
            if 10 * len(a & b) >= 8 * len(a | b):
                links.update([a, b])
                later.add(max(a, b, key=first.__getitem__))
    gone, total = Counter(), Counter()
    for doc, k, s in lines:
        gone[doc] += s in later or first[s] != (doc, k)
        total[doc] += links[s]
    for r in line_dedup.similar_lines(docs).collect():
        assert (len(r.removed), r.n_links) == (gone[r.doc_id], total[r.doc_id]), r.doc_id


def test_lines_of_hot_tokens_against_one_task(spark):
    """Tokens with more than a few sets are cut into cells, wide groups are looked up: same links."""
    head = "the same long header of all these pages stands here again"
    rows = [(i, f"{head} {i}\n{head} number {i % 7}\nrow {i} alone") for i in range(90)]
    rows += [(100 + i, " ".join(f"w{k}" for k in range(i, i + 40))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = by_id(line_dedup.similar_lines(docs).withColumn("removed", F.col("removed").cast("string")))
    assert sum(r[4] * n for r, n in expected.items()) > 90 * 89
    batch, width = "spark.sql.execution.arrow.maxRecordsPerBatch", line_dedup.NARROW
    try:
        spark.conf.set(batch, 4)
        stored = line_dedup._line_rows(
            docs.withColumn("hash", F.xxhash64("text")), np.arange(1 << 20, dtype=np.uint32), 0.8
        )
        sides = line_dedup._candidates(line_dedup._postings(stored), 0.8, 5, 3)
        assert {r.side for r in sides.select("side").distinct().collect()} == {0, 1, 2}
        found = line_dedup.similar_lines(docs, hot=5, block=3)
        assert by_id(found.withColumn("removed", F.col("removed").cast("string"))) == expected
    finally:
        spark.conf.unset(batch)


@pytest.mark.parametrize("narrow", [(2, 16), (1, 1), (0, 0)])
def test_exact_overlaps_of_sets(narrow, monkeypatch):
    monkeypatch.setattr(line_dedup, "NARROW", narrow)
    rng = np.random.default_rng(5)
    sets, group, token = [], [], []
    for g, names in enumerate((12, 300, 40)):
        of = [np.sort(rng.choice(names, rng.integers(4, 12), replace=False)) for _ in range(40)]
        of += [np.unique(np.r_[x, rng.integers(0, names, 1)]) for x in of]
        sets += sorted(of, key=len)
        group += [g] * len(of)
        token += [names // 3] * len(of)
    size = np.array([len(x) for x in sets])
    group, token = np.array(group), np.array(token)
    judged = line_dedup.Sets(group, token, np.concatenate(sets).astype(np.uint64), size)
    found = {(i, j) for pairs in judged.matches(np.zeros(len(sets), int), 0.8) for i, j in zip(*map(list, pairs))}
    expected = set()
    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            common = set(a) & set(sets[j])
            alike = len(common) >= 0.8 * len(set(a) | set(sets[j]))
            if group[i] == group[j] and alike and min(common) >= token[i]:
                expected.add((i, j))
    assert found == expected and expected


def test_lines_of_odd_rows(spark):
    found = {(r.doc_id, r.n_lines): r.removed for r in line_dedup.similar_lines(odd(spark)).collect()}
    assert found[6, 3] == [1, 2]
    assert found[2, 0] == found[3, 0] == found[4, 0] == []
    assert found[None, 1] == [0] and found[1, 1] == []
    left = line_dedup.remove_lines(odd(spark), line_dedup.similar_lines(odd(spark)))
    assert left.columns == odd(spark).columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[6] == "alpha beta gamma delta" and None not in texts and texts[2] is None


def test_lines_of_a_text_with_many_line_breaks():
    many = (1 << 20) + 5
    rarity = np.arange(1 << 20, dtype=np.uint32)

    def lines(*texts):
        return line_dedup.Lines(*next(features.pieces(pa.array(texts), 1 << 30)), rarity)

    blank = lines("alpha beta" + "\n" * (1 << 20) + "gamma delta", "gamma delta")
    assert blank.place.tolist() == [0, 1 << 20, 0] and blank.text.tolist() == [0, 0, 1]
    assert blank.size.tolist() == [2, 2, 2] and blank.hash[1] == blank.hash[2] != blank.hash[0]
    full = lines("\n".join(map(str, range(many))), f"{many - 1}")
    assert full.place.tolist() == [*range(many), 0] and (full.size == 1).all()
    assert full.hash[-2] == full.hash[-1] and len(np.unique(full.hash)) == many


def brute_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        cover = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                cover[i : i + length] = b"\1" * length
        runs = sum(1 for i, c in enumerate(cover) if c and (i == 0 or not cover[i - 1]))
        kept = bytes(x for x, c in zip(t, cover) if not c)
        yield len(t), sum(cover), runs, hashlib.sha256(kept).hexdigest()


def test_suffixes_against_brute_force(spark):
    a, b, c = ("".join(chr(97 + (i * i * k + i // 3) % 26) for i in range(300)) for k in (3, 5, 7))
    texts = [a + b, c + a[40:200], b[100:] + a[:120] + c, a * 2, "x" * 400, "é" * 90, a[:59], None, "", "ab" * 200, b + "z" + b]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(0, a + b)], "doc_id long, text string")
    found = suffix_dedup.repeated_passages(docs, length=60)
    wanted = list(brute_repeats([(t or "").encode() for t in [*texts, a + b]], 60))
    got = sorted(tuple(r) for r in suffix_dedup.digests(found).collect())
    assert got == sorted((i, *w) for i, w in zip([*range(len(texts)), 0], wanted))
    kept = {r.doc_id: hashlib.sha256(r.kept).hexdigest() for r in suffix_dedup.kept_bytes(docs, found).collect()}
    assert kept == {i: w[3] for i, w in zip(range(len(texts)), wanted)}


def test_loser_tree_merges():
    words = sorted(w.encode() for w in "a ab abc abd b ba bab banana band c ca cab cat cat dog do d".split())
    for k in (1, 2, 3, 5, 8):
        runs = [suffix_dedup.decode(suffix_dedup.encode([(w, b"", i, False) for i, w in enumerate(words[r::k])])) for r in range(k)]
        out, before = [], b""
        for _, shared, entry in suffix_dedup.merge(runs):
            assert shared == suffix_dedup.common(before, entry[1], 0)
            out.append(before := entry[1])
        assert out == words


def test_near_duplicates(spark):
    words = [f"w{i}" for i in range(300)]
    near = " ".join([*words[:150], "other", *words[151:]])
    far = " ".join(f"v{i}" for i in range(300))
    rows = [(1, " ".join(words)), (2, near), (3, far), (4, far), (None, far), (5, None), (6, ""), (3, far)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(docs).collect()
    classes = {r.doc_id: r.class_id for r in found}
    assert len(found) == 8 and classes == {1: 1, 2: 1, 3: 3, 4: 3, None: 3, 5: 5, 6: 5}
    assert Counter(r.doc_id for r in found if r.stays) == {1: 1, 3: 2, 5: 1}


def test_near_duplicates_against_brute_force(spark):
    """All pairs of different texts, with exact document frequencies: weighted Jaccard of 0.8 or more is
    one class, and each text of a class has a partner (the sketch moves a similarity by less than 0.02)."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    grams, frequency = {}, Counter()
    for _, text in rows:
        words = re.findall(r"[^ \t-\r]+", text or "")
        grams[text] = Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4) if words else 0))
        frequency.update(grams[text].keys())
    factor = {g: 1 + math.log(len(rows) / n) / math.log(len(rows)) for g, n in frequency.items()}
    weight = {t: sum(n * factor[g] for g, n in c.items()) for t, c in grams.items()}
    holders = {}
    for text, counts in grams.items():
        for g in counts:
            holders.setdefault(g, []).append(text)
    both = Counter()
    for g, texts in holders.items():
        for i, a in enumerate(texts):
            for b in texts[:i]:
                both[a, b] += min(grams[a][g], grams[b][g]) * factor[g]
    similarity = {(a, b): x / (weight[a] + weight[b] - x) for (a, b), x in both.items()}

    classes = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows)).collect()}
    of = {text: classes[doc_id] for doc_id, text in rows}
    assert all(of[text] == classes[doc_id] for doc_id, text in rows)
    alike = [(a, b) for (a, b), x in similarity.items() if x >= 0.8]
    together = sum(of[a] == of[b] for a, b in alike)
    print(f"near pairs {len(alike)}, in one class {together}")
    assert alike and together >= 0.9 * len(alike)
    partners = {t for (a, b), x in similarity.items() if x >= 0.78 and of[a] == of[b] for t in (a, b)}
    members = Counter(of.values())
    assert {t for t in of if members[of[t]] > 1} <= partners


def test_decontamination_of_odd_rows(spark):
    items = spark.createDataFrame([(1, "Five SIX seven"), (2, None), (3, ""), (None, "alpha beta")], ITEMS)
    found = {r.doc_id: r for r in decontaminate.contamination(odd(spark), items).collect()}
    assert found[1].n_hit == 36 and found[1]["items"] == ["1"] and found[None].n_hit == 36
    assert found[6].n_hit == 6 and found[6]["items"] == [] and found[2].n_words == 0
    near = spark.createDataFrame([(9, "five seven eight")], ITEMS)
    loose = {r.doc_id: r for r in decontaminate.contamination(odd(spark), near, slop=1).collect()}
    assert loose[1].n_hit == 0 and loose[1].near_items == ["9"]


def test_chat_round_trip(spark):
    texts = [None, "", "</s>[INST] ok [/INST]", "\\", "[\\INST]", "<<SYS>>x<<:>>y<</SYS>>", "[[INST]<", "é\n<s>"]
    rows = [(1, k % 3, role, t) for k, t in enumerate(texts) for role in ("user", "assistant", "system", None, "<s>")]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    row = made.first()
    assert row.identical
    source = sorted((t, r or "", x or "") for _, t, r, x in rows)
    assert [(p.role, p.text) for p in row.parsed] == [(r, x) for _, r, x in source]
    learned = chat.digests(made).first()
    assert learned.loss_chars == sum(len(x) for _, r, x in source if r == "assistant")
    broken = spark.createDataFrame([("[INST]a</s>",), ("x",), ("[INST]a[/INST]b",)], "s string")
    assert [r[0] for r in broken.select(chat.parse(broken.s)).collect()] == [None] * 3


@pytest.mark.parametrize("n", [0, 1])
def test_chat_of_odd_or_no_rows(spark, n):
    """NULLs everywhere, repeated rows, a long text, a long conversation, and columns named like the operator's own."""
    long = [(9, i, ("user", "assistant")[i % 2], f"turn {i} é</s> " * 8) for i in range(1500)]
    rows = [(None, None, None, None), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, None, "assistant", "<s>" * 40_000), *long]
    extra = [F.lit(k).alias(c) for k, c in enumerate(["plain", "out", "place", "upto", "turns", "formatted", "loss", "span", "shown"])]
    docs = spark.createDataFrame(rows * n, "conv_id long, turn long, role string, text string").select("*", *extra)
    made = {r.conv_id: r for r in chat.digests(chat.format_conversations(docs)).collect()}
    assert {k: r.n_turns for k, r in made.items()} == ({None: 1, 1: 3, 9: 1500} if n else {})
    if n:
        learned = "".join(t for _, i, _, t in long if i % 2)
        assert made[1].loss_chars == 120_000 and made[9].loss_chars == len(learned)
        assert made[9].formatted_chars > 2 * chat.CUT
        assert made[9].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_mix_of_odd_rows(spark):
    mixed = mixing.mix(odd(spark))
    assert mixed.count() == len(ODD) and by_id(mixed) == by_id(mixing.mix(odd(spark)))
    rows = mixed.collect()
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        assert sum(r.taken for r in mine) == int(mine[0].target)


def test_mix_spreads_rows_without_an_id(spark):
    """A third of the rows has no id, and many of these are one text; the cut is in hash order and exact."""
    texts = ["one text " * 3] * 300 + ["w " * (k % 9) + str(k) for k in range(300)]
    rows = [(None, t, "a") for t in texts] + [(k, "x " * (k % 7 + 1), "ab"[k % 2]) for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    mixed = mixing.mix(docs, weights=(1, 9))
    taken = mixed.collect()
    assert by_id(mixed) == by_id(mixing.mix(docs.repartition(3), weights=(1, 9)))
    key = lambda i, t: hashlib.md5((str(i) if i is not None else ":" + hashlib.md5(t.encode()).hexdigest()).encode()).hexdigest()
    expected = Counter()
    for source in "ab":
        mine = sorted((key(i, t), len(t.split()), i is None, i or 0) for i, t, s in rows if s == source)
        whole = sum(size for _, size, _, _ in mine)
        left = int(next(r.target for r in taken if r.source == source))
        epochs, left = divmod(left, whole)
        for _, size, unnamed, i in mine:
            more, left = min(size, left), left - min(size, left)
            expected[None if unnamed else i, source, size, epochs * size + more] += 1
    assert Counter((r.doc_id, r.source, r["size"], r.taken) for r in taken) == expected


def test_secrets_of_odd_rows(spark):
    found = {r.doc_id: r for r in secret_scan.digests(secret_scan.scan(odd(spark))).collect()}
    assert found[7].n_assign == 1 and found[7].spans == "assign:14:35"
    assert found[2].spans == found[5].spans == ""


def entropy_of(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in secret_scan.digests(secret_scan.scan(docs)).collect()}
    return [found[i] for i in range(len(texts))]


def test_only_the_windows_at_a_sample_value_are_allowed(spark):
    key = "q7Xv9LmZt2RwB8sKfP4dNc6HjYg3TuEa"
    alone, path, behind, sample = entropy_of(spark, key, f"/srv/example/key/{key}", f"{key}EXAMPLE", "exampleKey1/example2/a3")
    assert alone == f"entropy_base64:0:{len(key)}"
    start = len("/srv/example")
    assert path == f"entropy_base64:{start}:{start + 5 + len(key)}"
    assert behind == f"entropy_base64:0:{len(key)}" and sample == ""


def test_letters_without_a_digit(spark):
    random = "qXvLmZtRwBsKfPdNcHjYgTuEaqWe"
    words = ["the_quick_brown_fox_jumped", "TheQuickBrownFoxJumpedOver", "HTTPServerErrorMessage/Handler", "LICENSE_NOTICE_AND_TERMS", "12345-67890-24680-13579"]
    found = entropy_of(spark, random, *words, "1f0b5c7e-9d3a-4e82-b6f1-0c2d4a6e8b97")
    assert found[0] == f"entropy_base64:0:{len(random)}" and not any(found[1:6])


BASE_COUNTS = r"""
with words as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), lines as (
  select doc_id, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l from words
), windows as (
  select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from (
    select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c
    from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from words))
), repeated as (
  select doc_id, count(distinct i + d) as n from windows, range(3) as steps(d) where n > 1 group by doc_id
), counts as (
  select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines,
    coalesce(n, 0) as n_repeat_words
  from words join lines using (doc_id) left join repeated using (doc_id)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts"""


def test_base_counts_against_sql(spark, con):
    found = QUERIES["op3_quality_rules"](spark, SF_DIR)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert spark_rows(found.select(names)) == sql_rows(con, BASE_COUNTS)
    assert found.where("base_failed and kept").isEmpty()


def test_rules_of_odd_rows(spark):
    labels = spark.createDataFrame([], LABELS)
    found = {r.doc_id: r for r in quality_rules.apply_rules(odd(spark), labels).collect()}
    assert found[6].n_dup_lines == 1 and found[6].n_repeat_words == 12 and found[6].base_failed
    assert found[5].n_words == 30_000 and found[5].base_failed and found[2].n_words == 0


def test_held_out_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = quality_rank.quality_scores(docs, labels).where("held_out").join(labels, "doc_id")
    right = scored.selectExpr("avg(double(predicted = quality))", "avg(double(predicted = quality)) filter (where quality = 1)").first()
    assert right[0] > 0.95 and right[1] > 0.97


def test_quality_threshold_covers_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(quality_rank, "PER_CLASS", 20)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = quality_rank.quality_scores(docs, labels).where("not held_out").join(labels, "doc_id")
    # Distance to the threshold, in units of the scale.
    away = {c: sorted(math.log(r.score / (1 - r.score)) - math.log(3 / 7) for r in found.where(f"quality = {c}").collect()) for c in (0, 1)}
    assert all(len(x) > 40 for x in away.values())
    low, high = (away[c][math.ceil(round(share * len(away[c]), 9)) - 1] for c, share in ((0, 0.998), (1, 0.002)))
    assert abs(low + (high - low) / 3) < 1e-6


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(3)
    wide = [float(x) for x in np.r_[rng.normal(size=2000), rng.normal(size=2000) * 1e-9, [0.25] * 500, -1e12, 3e-300]]
    rows = spark.createDataFrame([(x, x if x < 0 else None, None) for x in wide], "x double, y double, z double")
    shares = (0.0, 0.002, 0.3, 0.5, 0.501, 0.998, 1.0)
    for name, values in (("x", sorted(wide)), ("y", sorted(x for x in wide if x < 0))):
        expected = [values[max(1, math.ceil(s * len(values))) - 1] for s in shares]
        assert models.quantiles(rows, *((F.col(name), s) for s in shares)) == expected
    assert models.quantiles(rows, (F.col("z"), 0.5), (F.col("x"), 1.0)) == [None, max(wide)]
    assert models.quantiles(rows.limit(0), (F.col("x"), 0.5)) == [None]


def test_toxicity_of_few_rows(spark):
    clean = [(i, f"plain words about river number {i} and the tree {i % 7}") for i in range(300)]
    bad = [(i, f"you idiot about river number {i} idiot") for i in range(300, 400)]
    docs = spark.createDataFrame(clean + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i >= 300)) for i in range(400)], LABELS)
    scored = toxicity.toxicity_scores(docs, labels).where("held_out").collect()
    assert sum(r.predicted == (r.doc_id >= 300) for r in scored) >= 0.9 * len(scored)


def test_toxicity_threshold_covers_all_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "UNLABELLED", 30)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    prior = labels.where(~held_out(F.col("doc_id"))).agg(F.avg("toxic")).first()[0]
    scores = [r.score for r in toxicity.toxicity_scores(docs, labels).where("not held_out").collect()]
    highest = max(x for x in scores if x < 0.5)
    above, upto = sum(x > 0.5 for x in scores), sum(x >= highest for x in scores)
    assert above <= prior * len(scores) + 1e-6 and upto >= prior * len(scores) - 1e-6


def test_toxicity_of_rare_words(spark):
    learn, unseen = ([i for i in range(400) if (crc32(str(i).encode()) % 5 == 0) == out] for out in (False, True))
    bad = [*learn[:4], *unseen[:3]]  # with the unlabelled sample, 8 texts have the word
    docs = [(i, f"words about the {'zorkwit ' * (i in bad)}river {i % 7}") for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i in bad)) for i in range(400)], LABELS)
    found = toxicity.toxicity_scores(spark.createDataFrame(docs, "doc_id long, text string"), labels).collect()
    scores = {r.doc_id: r.score for r in found}
    assert min(scores[i] for i in bad) > max(scores[i] for i in scores if i not in bad)


@pytest.mark.parametrize("n", [0, len(ODD)])
def test_no_operator_breaks_on_odd_or_no_rows(spark, n):
    docs = odd(spark, ODD[:n])
    labels = spark.createDataFrame([(None, 1, None), (1, None, 1), (5, 0, 0)], LABELS)
    items = spark.createDataFrame([] if not n else [(1, "five six")], ITEMS)
    assert line_dedup.similar_lines(docs).count() == n
    assert toxicity.toxicity_scores(docs, labels).count() == n
    assert quality_rules.apply_rules(docs, labels).count() == n
    assert suffix_dedup.repeated_passages(docs).count() == n
    assert decontaminate.contamination(docs, items).count() == n
    assert near_dedup.near_duplicates(docs).count() == n
    assert mixing.mix(docs).count() == n
    assert secret_scan.scan(docs).count() == n
    assert quality_rank.quality_scores(docs, labels).count() == n
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF_DIR)
        assert left.columns == docs.columns and left.count() <= n, name
    assert corpus_pipeline.mixture(spark, docs, SF_DIR).count() <= n


def test_stages_keep_columns_with_clashing_names(spark):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(1, words), (2, words + "\nmore"), (None, "some other line"), (4, None)]
    names = ["_doc", "_key", "_hash", "_n", "_gone", "hash", "key", "row", "removed", "n_lines", "label", "size", "taken", "key.x"]
    extra = [F.lit(k).alias(name) for k, name in enumerate(names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit("en").alias("lang"), F.lit("a").alias("source"), F.lit(5).cast("long").alias("n_chars"), *extra
    )
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        left = stage(spark, docs, SF_DIR)
        assert left.schema.names == docs.schema.names, name
        found = left.collect()
        assert found and all(tuple(r)[5:] == tuple(range(len(names))) for r in found), name
    texts = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, SF_DIR).collect()}
    assert texts == {1: words, 2: "more", None: "some other line", 4: None}
    assert corpus_pipeline.quality(spark, docs, SF_DIR).columns == docs.columns
    assert {r.doc_id for r in corpus_pipeline.mixture(spark, docs, SF_DIR).collect()} <= {1, 2, None}


def lines_left(docs):
    """Texts without the lines that match an earlier one, every set against every earlier set."""
    sets, left = [], {}
    for i in sorted(docs):
        kept, words = [], 0
        for line in (docs[i] or "").split("\n"):
            tokens = frozenset(line.encode().split())
            goes = bool(tokens) and any(10 * len(tokens & s) >= 8 * len(tokens | s) for s in sets)
            sets += [tokens] if tokens else []
            words += bool(tokens) and not goes
            kept += [] if goes else [line]
        if words or not (docs[i] or "").split():
            left[i] = "\n".join(kept)
    return left


def one_of_each(docs):
    """Ids of the documents that stay: the smallest of each class of near duplicates."""
    sets = {}
    for i, text in docs.items():
        w = text.encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    name = {i: i for i in docs}
    for i in docs:
        for j in docs:
            same = 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])
            if j < i and name[i] != name[j] and (docs[i] == docs[j] or (same and docs[i].split())):
                low, high = sorted((name[i], name[j]))
                name = {k: low if v == high else v for k, v in name.items()}
    return {i for i in docs if name[i] == i}


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 250")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")

    def run(k, docs):
        left = freeze(corpus_pipeline.STAGES[k][1](spark, docs, SF_DIR), "stage")
        return left, {r.doc_id: r.text or "" for r in left.collect()}

    good, texts = run(0, docs)
    scored = quality_rank.quality_scores(docs, labels).collect()
    assert set(texts) == {r.doc_id for r in scored if r.score >= 0.3} and len(texts) > 100

    cut, after = run(1, good)
    assert after == lines_left(texts)
    assert all(r.n_chars == len(r.text) for r in cut.where("text is not null").collect())

    single, kept = run(2, cut)
    assert set(kept) == one_of_each(after)

    clean, left = run(3, single)
    items = [bench_words(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    windows = {tuple(w[k : k + 10]) for w in items if w for k in range(max(1, len(w) - 9))}
    lengths = {len(w) for w in windows}

    def leaks(text):
        w = bench_words(text)
        return any(tuple(w[k : k + n]) in windows for n in lengths for k in range(len(w) - n + 1))

    assert set(left) == {i for i, text in kept.items() if not leaks(text)}

    mixed = corpus_pipeline.mixture(spark, clean, SF_DIR).collect()
    sizes = {i: len(text.encode().split()) for i, text in left.items()}
    assert len({r.doc_id for r in mixed}) == len(mixed)
    assert all(r["size"] == sizes[r.doc_id] and 0 < r.taken <= 3 * r["size"] for r in mixed)
    targets = {r.source: r.target for r in mixed}
    assert all(sum(r.taken for r in mixed if r.source == s) == int(t) for s, t in targets.items())
    assert abs(sum(targets.values()) - sum(sizes.values())) < len(targets)
