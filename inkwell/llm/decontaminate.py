r"""Benchmark decontamination with a positional inverted index.

`build_index` writes the postings (row, term, place) of every token of the training texts whose
term the test set uses, one segment per input partition, and one header per document with its
length. `find` starts each window of the test set from its rarest term: that term's postings,
moved back by the term's offset, are the places where the window can begin. These are
intersected with the moved postings of the second-rarest term, and what is left with those of
all other terms. With `slop` s a term also counts up to s words off its place; such matches
are proximity matches, those with every term in place are exact.

Column expressions only. The vocabulary, the windows and the rows of the remaining documents
are broadcast after a count has shown that they are small; beyond that they are joined by a
shuffle. Counting and intersecting never bring the postings of a term into one task: postings
are spread by (row, term, place).

Words are runs of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lower-casing A-Z. An item shorter than
a window is one window; NULL and empty texts have no words and match nothing. Rows that repeat
are matched one by one; items with equal ids count once, items without an id hit words but
aren't listed. Empty tables give no rows or no hits. Other columns are ignored.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import text_key
from inkwell.sources.scratch import freeze

# Fixed values.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS_PER_WINDOW = 10

# Rows that may be broadcast: terms and windows of about 100 bytes, row numbers of 8.
SMALL_TABLE = 200_000
SMALL_ROWS = 2_000_000


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(TOKEN), F.lit(0))


def _small(df: DataFrame, most: int) -> DataFrame:
    """`df`, to be broadcast if it has been counted and is small."""
    return F.broadcast(df) if df.count() <= most else df


@dataclass
class Index:
    """headers: row, doc_id, key, n_words; postings: row, term, place (from 1)."""

    headers: DataFrame
    postings: DataFrame


def windows_of(items: DataFrame, size: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (window, terms) and where they are from (item, window)."""
    if not 0 < size <= 62:  # terms found are kept as bits of a long
        raise ValueError("a window has 1 to 62 words")
    said = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("words"))
    n = F.size("words")
    start = F.sequence(F.lit(1), F.greatest(F.lit(1), n - (size - 1)))
    cut = said.where(n > 0).select("item", "words", F.explode(start).alias("start"))
    terms = cut.select("item", F.slice("words", F.col("start"), F.lit(size)).alias("terms"))
    named = freeze(terms.withColumn("window", F.array_join("terms", " ")).distinct(), "windows")
    return named.select("window", "terms").distinct(), named.select("item", "window")


def build_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index the tokens of all documents whose term is in `terms` (term, distinct)."""
    # Place 0 holds the header: a blank, the length, a blank, the key of the text.
    found = words(F.col("text"))
    header = F.concat(F.lit(" "), F.size(found).cast("string"), F.lit(" "), text_key(F.col("text")))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
    )
    placed = rows.select(
        "row", "doc_id", F.posexplode(F.concat(F.array(header), found)).alias("place", "term")
    )
    known = _small(terms, SMALL_TABLE).withColumn("known", F.lit(True))
    wanted = placed.join(known, "term", "left").where(F.col("known") | (F.col("place") == 0))
    stored = freeze(
        wanted.select("row", F.when(F.col("place") == 0, F.col("doc_id")).alias("doc_id"), "term", "place"),
        "postings",
    )
    parts = F.split("term", " ")
    headers = stored.where(F.col("place") == 0).select(
        "row", "doc_id", F.get(parts, 2).alias("key"), F.get(parts, 1).cast("long").alias("n_words")
    )
    return Index(headers, stored.where(F.col("place") > 0).select("row", "term", "place"))


def _intersect(starts: DataFrame, terms: DataFrame, postings: DataFrame, slop: int) -> DataFrame:
    """Keep the (row, id, start) at which every one of the window's `terms` (id, off, term, needed)
    has a posting, with `exact` telling whether all are in place."""
    need = starts.join(terms, "id").withColumn("moved", F.explode(F.sequence(F.lit(-slop), F.lit(slop))))
    need = need.withColumn("place", F.col("start") + F.col("off") + F.col("moved"))
    # Only one side repeats a key, and there are few of it: hash it, stream the postings.
    met = postings.join(need.hint("shuffle_hash"), ["row", "term", "place"])
    offset = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("off").cast("int"))
    in_place = F.when(F.col("moved") == 0, offset).otherwise(F.lit(0).cast("long"))
    return (
        met.groupBy("row", "id", "start")
        .agg(
            F.bit_or(offset).alias("any"),
            F.bit_or(in_place).alias("strict"),
            F.max("needed").alias("needed"),
            F.min("exact").alias("exact"),
        )
        .where(F.col("any") == F.col("needed"))
        .select("row", "id", "start", (F.col("exact") & (F.col("strict") == F.col("needed"))).alias("exact"))
    )


def find(index: Index, windows: DataFrame, slop: int = 0) -> DataFrame:
    """Matches (row, window, start, n, exact) of the windows (window, terms) in the index; with
    `slop` also those whose terms are up to so many words off their place."""
    counts = index.postings.groupBy("term").agg(F.count("*").alias("n_postings"))
    terms = windows.select("window", "terms", F.posexplode("terms").alias("off", "term"))
    rarest_first = Window.partitionBy("window").orderBy("n_postings", "off")
    ranked = freeze(
        terms.join(counts, "term", "left")
        .withColumn("n_postings", F.coalesce("n_postings", F.lit(0)))
        .withColumn("rank", F.row_number().over(rarest_first))
        .withColumn("least", F.min("n_postings").over(Window.partitionBy("window")))
        .where(F.col("least") > 0)  # a term that no document has rules out its window
        .withColumn("id", F.md5(F.col("window").cast("binary")))
        .withColumn("n", F.size("terms")),
        "ranked",
    )
    n_terms = ranked.count()

    def ranks(condition: Column) -> DataFrame:
        chosen = ranked.where(condition).select("id", "off", "term")
        offset = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("off").cast("int"))
        needed = chosen.groupBy("id").agg(F.bit_or(offset).alias("needed"))
        chosen = chosen.join(needed, "id")
        return F.broadcast(chosen) if n_terms <= SMALL_TABLE else chosen

    def postings_of(condition: Column) -> DataFrame:
        chosen = ranked.where(condition).select("term").distinct()
        return index.postings.join(F.broadcast(chosen) if n_terms <= SMALL_TABLE else chosen, "term", "left_semi")

    rarest, second, others = F.col("rank") == 1, F.col("rank") == 2, F.col("rank") > 2
    first = ranked.where(rarest).select("term", "id", "off", "n")
    first = F.broadcast(first) if n_terms <= SMALL_TABLE else first
    starts = (
        index.postings.join(first, "term")
        .withColumn("start", F.col("place") - F.col("off"))
        .where(F.col("start") > 0)
        .select("row", "id", "start", "n", F.lit(True).alias("exact"))
    )
    # Windows of one word are done; windows of two after the next step.
    alone = starts.where(F.col("n") == 1).drop("n")
    both = _intersect(starts.where(F.col("n") > 1).drop("n"), ranks(second), postings_of(second), slop)
    both = freeze(both, "starts")
    lengths = ranked.where(rarest).select("id", "window", "n")
    lengths = F.broadcast(lengths) if n_terms <= SMALL_TABLE else lengths
    named = both.join(lengths.select("id", "n"), "id")
    pairs = named.where(F.col("n") == 2).drop("n")
    longer = named.where(F.col("n") > 2).drop("n")
    rows = _small(both.select("row").distinct(), SMALL_ROWS)
    whole = _intersect(longer, ranks(others), index.postings.join(rows, "row", "left_semi"), slop)
    found = alone.unionByName(pairs).unionByName(whole)
    return found.join(lengths, "id").select("row", "window", "start", "n", "exact")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = WORDS_PER_WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    slop: int = 0,
) -> DataFrame:
    """One row per document: doc_id, key (of the text), n_words, n_hit, items (ids with exactly
    occurring windows, sorted as strings), near_items (ids with proximity matches only)."""
    windows, sources = windows_of(items, size, item_id_col, item_text_col)
    index = build_index(docs, windows.select(F.explode("terms").alias("term")).distinct(), id_col, text_col)
    matches = freeze(find(index, windows, slop), "matches")
    exact = matches.where("exact")
    covered = exact.select("row", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("place"))
    hits = covered.distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    by_item = (
        matches.groupBy("row", "window")
        .agg(F.max("exact").alias("exact"))
        .join(sources.where(F.col("item").isNotNull()), "window")
        .groupBy("row", "item")
        .agg(F.max("exact").alias("exact"))
    )
    listed = by_item.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("items"),
        F.sort_array(F.collect_list(F.when(~F.col("exact"), F.col("item")))).alias("near_items"),
    )
    none = F.array().cast("array<string>")
    return (
        index.headers.join(hits, "row", "left")
        .join(listed, "row", "left")
        .select(
            "doc_id",
            "key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("near_items", none).alias("near_items"),
        )
    )


def digests(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
