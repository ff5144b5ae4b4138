r"""Secrets in texts: assignments, access keys, hex runs, and windows of high entropy.

Column expressions only. A text is cut at the matches of each pattern; the lengths of the
pieces and matches, summed up by a window, are the positions. The exploded matches are
written once, so their row numbers stay the same for what follows.

The entropy of a candidate string (a long run of one character class) is taken over a
sliding window of `WINDOW` characters by incremental counts. With S = sum of c*log2(c) over
the characters' counts c, the entropy is log2(WINDOW) - S / WINDOW. A character that enters as
the c-th of its kind adds g(c) = c*log2(c) - (c-1)*log2(c-1), one that leaves while there are
c takes g(c) off. Both counts are window functions over (string, character), S is a running
sum. g is kept in whole billionths, so sums are exact.

Cases: NULL text is empty; repeated rows each get their row; an empty table gives none. Other
columns are ignored. Positions are code points, ends exclusive.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.sources.scratch import freeze

# Fixed values.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy_base64", "entropy_hex")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

WINDOW = 20
CANDIDATES = {"entropy_base64": r"[A-Za-z0-9+/_=-]{20,}", "entropy_hex": r"[0-9A-Fa-f]{20,}"}
LEAST_BITS = {"entropy_base64": 3.75, "entropy_hex": 3.0}
# Whole strings without a secret: nothing but digits and signs, a UUID.
ALLOWED = (
    r"^[0-9+/_=-]+$"
    r"|^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
)
# Words and names written together have no digit, no small letter on its own, and no capital on its own that
# no small letter follows. What has one of these is no such string.
NOT_WORDS = r"[0-9]|(^|[^a-z])[a-z]([^a-z]|$)|(^|[^A-Z])[A-Z]([^A-Za-z]|$)"
# Sample values: a window that touches one is no secret, other windows of the string may be.
SAMPLES = ("EXAMPLE", "example", "0123456789", "1234567890", "abcdefghij", "ABCDEFGHIJ")
MASK = "\x01"
UNIT = 1_000_000_000


def gain(c: int) -> int:
    """What the c-th character of a kind adds to the sum of c*log2(c), in billionths."""
    before = (c - 1) * math.log2(c - 1) if c > 1 else 0.0
    return round((c * math.log2(c) - before) * UNIT)


def most_sum(kind: str) -> int:
    """The largest S of a window with the bits that `kind` asks for."""
    return math.floor(WINDOW * (math.log2(WINDOW) - LEAST_BITS[kind]) * UNIT)


def _found(text: Column, kind: str, pattern: str, least: int, group: int = 0) -> Column:
    """An array of (kind, i, gap, length, ok, value): the i-th match and the text before it."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    pieces = F.split(text, pattern)
    entropy = kind in CANDIDATES

    def one(z, i):
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            i.alias("i"),
            F.length(z["piece"]).alias("gap"),
            F.length(z["match"]).alias("length"),
            (F.length(z["part"]) >= least).alias("ok"),
            (z["match"] if entropy else F.lit(None).cast("string")).alias("value"),
        )

    zipped = F.arrays_zip(pieces.alias("piece"), matches.alias("match"), judged.alias("part"))
    return F.filter(F.transform(zipped, one), lambda m: m["length"].isNotNull())


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Matches of every text as (row, doc_id, kind, start, end, ok, value); a row without any
    match is there once, with NULLs."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # A run of 24 or more hex digits is found as such: shorter runs are dropped anyway, and
    # a run can only be matched whole. The same holds for access keys.
    long_hex = HEX.replace("+", f"{{{LEAST_HEX},}}")
    long_access = ACCESS.replace("+", f"{{{LEAST_ACCESS - 4},}}")
    found = F.concat(
        _found(F.col("text"), "assign", ASSIGN, LEAST_ASSIGN, 2),
        _found(F.col("text"), "access", long_access, LEAST_ACCESS),
        _found(F.col("text"), "hex", long_hex, LEAST_HEX),
        *(_found(F.col("text"), k, p, WINDOW) for k, p in CANDIDATES.items()),
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
    )
    flat = freeze(
        rows.select("row", "doc_id", F.explode_outer(found).alias("m")).select("row", "doc_id", "m.*"),
        "matches",
    )
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(upto)
    return flat.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))


def entropy_spans(candidates: DataFrame) -> DataFrame:
    """(row, doc_id, kind, start, end): in each candidate string, from the first window that has
    enough bits and touches no sample value to the end of the last one."""
    strings = candidates.where(~F.col("value").rlike(ALLOWED) & F.col("value").rlike(NOT_WORDS))
    for sample in SAMPLES:
        strings = strings.withColumn("value", F.replace("value", F.lit(sample), F.lit(MASK * len(sample))))
    # All that follows needs the characters of a string together: one shuffle, by string.
    chars = strings.repartition("row", "kind", "start").select(
        "row",
        "doc_id",
        "kind",
        "start",
        F.posexplode(F.slice(F.split("value", ""), 1, F.length("value"))).alias("at", "ch"),
    )
    same = Window.partitionBy("row", "kind", "start", "ch").orderBy("at")
    gains = F.array(*(F.lit(gain(c)) for c in range(1, WINDOW + 1)))
    entering = F.count("*").over(same.rangeBetween(1 - WINDOW, 0))
    leaving = F.count("*").over(same.rangeBetween(0, WINDOW - 1))
    deltas = chars.withColumn("add", F.element_at(gains, entering.cast("int"))).withColumn(
        "off", F.element_at(gains, leaving.cast("int"))
    )
    string = Window.partitionBy("row", "kind", "start").orderBy("at")
    left = F.coalesce(F.lag("off", WINDOW).over(string), F.lit(0))
    sums = deltas.withColumn("delta", F.col("add") - left).withColumn(
        "s", F.sum("delta").over(string.rowsBetween(Window.unboundedPreceding, 0))
    )
    masked = F.sum((F.col("ch") == MASK).cast("int")).over(string.rowsBetween(1 - WINDOW, 0))
    sums = sums.withColumn("masked", masked)
    most = F.create_map(*(F.lit(x) for k in CANDIDATES for x in (KINDS.index(k), most_sum(k))))
    hot = sums.where((F.col("at") >= WINDOW - 1) & (F.col("masked") == 0) & (F.col("s") <= most[F.col("kind")]))
    return hot.groupBy("row", "doc_id", "kind", "start").agg(
        F.min("at").alias("first"), F.max("at").alias("last")
    ).select(
        "row",
        "doc_id",
        "kind",
        (F.col("start") + F.col("first") - (WINDOW - 1)).alias("start"),
        (F.col("start") + F.col("last") + 1).alias("end"),
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and spans, an array of (start, kind, end) sorted by start
    and then in the order of KINDS."""
    found = matches(docs, id_col, text_col)
    first_entropy = KINDS.index("entropy_base64")
    base = found.where(F.col("kind").isNull() | (F.col("kind") < first_entropy))
    candidates = found.where(F.col("kind") >= first_entropy)
    columns = ["row", "doc_id", "kind", "start", "end"]
    # A document whose only matches are candidates still needs its row.
    rows = found.where(F.col("kind") >= first_entropy).select(
        "row", "doc_id", *(F.lit(None).cast(t).alias(c) for c, t in (("kind", "int"), ("start", "long"), ("end", "long")))
    )
    spans = (
        base.select(*columns[:2], *(F.when(F.col("ok"), F.col(c)).alias(c) for c in columns[2:]))
        .unionByName(rows)
        .unionByName(entropy_spans(candidates).select(columns))
    )
    one = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end"))
    return spans.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(one)).alias("spans")).drop("row")


def digests(scanned: DataFrame) -> DataFrame:
    names = F.array(*map(F.lit, KINDS))

    def written(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(
                    ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
                ),
            ),
            ",",
        )

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("entropy_base64"))
    return scanned.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
