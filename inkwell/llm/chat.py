r"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn         := "[INST]" text "[/INST]"                      user
                  | "<s>" text "</s>"                            assistant
                  | "<<SYS>>" role "<<:>>" text "<</SYS>>"       any other role

The parser is deterministic: it cuts the rendered string at every control string, so the
pieces between them are texts and roles. `\x` stands for x. A turn is first rendered as it
is and parsed again; if that doesn't give back the turn, its text and role are escaped
(`\` doubled, a `\` behind the first character of every control string, which then is none),
which always round-trips, as an escaped text holds no control string and no lone `\`.
The whole conversation is then parsed again and compared once more (`identical`).

Column expressions only. One conversation is one row of the result, so its turns meet in
one task; its length is that of the formatted string asked for.

Cases: rows go by turn (NULL first), ties by role and text; NULL text and NULL role are
empty; rows that repeat are separate turns; NULL ids form one conversation; an empty table
gives no rows. Other columns are ignored.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

USER, ASSISTANT = "user", "assistant"
CONTROL = r"\[/?INST\]|</?s>|<<SYS>>|<</SYS>>|<<:>>"
# The first character of a control string, and the rest of it.
CONTROL_PARTS = r"([\[<])(/?INST\]|/?s>|<SYS>>|</SYS>>|<:>>)"
DOUBTFUL = rf"\\|{CONTROL}"
CUT = 1 << 16  # code points of a formatted string from which a learned text is copied


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL_PARTS, r"$1\\$2")


def unescape(text: Column) -> Column:
    plain = F.regexp_replace(text, r"(?s)\\(.)", "$1")
    return F.when(F.contains(text, F.lit("\\")), plain).otherwise(text)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), for which `value` is worked out once however often it is mentioned."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _turn(role: Column, text: Column, shown_role: Column) -> Column:
    return (
        F.when(role == USER, F.concat(F.lit("[INST]"), text, F.lit("[/INST]")))
        .when(role == ASSISTANT, F.concat(F.lit("<s>"), text, F.lit("</s>")))
        .otherwise(F.concat(F.lit("<<SYS>>"), shown_role, F.lit("<<:>>"), text, F.lit("<</SYS>>")))
    )


def parse(formatted: Column) -> Column:
    """Turns of a formatted string: an array of (role, text), NULL if it breaks the grammar."""
    cut = F.struct(
        F.regexp_extract_all(formatted, F.lit(f"({CONTROL})"), F.lit(1)).alias("marks"),
        F.split(formatted, CONTROL).alias("pieces"),
    )
    return _bound(cut, lambda c: _parsed(c["marks"], c["pieces"]))


def _parsed(marks: Column, pieces: Column) -> Column:
    pairs = F.greatest(F.size(marks) - 1, F.lit(0))
    # Two marks in a row, the piece between them, and those before and behind.
    zipped = F.arrays_zip(
        F.slice(marks, 1, pairs).alias("opened"),
        F.slice(marks, 2, pairs).alias("closed"),
        F.slice(pieces, 1, pairs).alias("before"),
        F.slice(pieces, 2, pairs).alias("said"),
        F.slice(pieces, 3, pairs).alias("behind"),
    )

    def turn(z):
        alone = z["behind"] == ""
        role = (
            F.when((z["opened"] == "[INST]") & (z["closed"] == "[/INST]") & alone, F.lit(USER))
            .when((z["opened"] == "<s>") & (z["closed"] == "</s>") & alone, F.lit(ASSISTANT))
            .when((z["opened"] == "<<:>>") & (z["closed"] == "<</SYS>>") & alone, unescape(z["before"]))
        )
        return F.struct(role.alias("role"), unescape(z["said"]).alias("text"))

    def checked(turns, opened):
        # Every mark belongs to a turn, every "<<:>>" has its "<<SYS>>" in front.
        count = F.aggregate(
            turns, F.lit(0), lambda n, t: n + F.when(t["role"].isin(USER, ASSISTANT), 2).otherwise(3)
        )
        clean = (
            (F.get(pieces, F.lit(0)) == "")
            & F.forall(turns, lambda t: t["role"].isNotNull())
            & F.forall(opened, lambda z: z["opened"] == "<<SYS>>")
            & (count == F.size(marks))
        )
        return F.when(clean, turns)

    def read(zs):
        closed = F.filter(zs, lambda z: z["closed"].isin("[/INST]", "</s>", "<</SYS>>"))
        opened = F.filter(zs, lambda z: z["closed"] == "<<:>>")
        return _bound(F.transform(closed, turn), lambda turns: checked(turns, opened))

    return _bound(zipped, read)


def format_conversations(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (an array of (start, length) of the
    assistants' texts in `formatted`, in code points from 1), parsed, identical."""
    said = rows.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    plain = _turn(F.col("role"), F.col("text"), F.col("role"))
    source = F.array(F.struct("role", "text"))
    # Only a control string or a `\` can make the parser read something else.
    doubtful = F.col("role").rlike(DOUBTFUL) | F.col("text").rlike(DOUBTFUL)
    said = said.withColumn("plain", plain).withColumn(
        "conflict",
        F.when(doubtful, ~F.coalesce(parse(F.col("plain")) == source, F.lit(False))).otherwise(F.lit(False)),
    )
    shown = F.when(F.col("conflict"), escape(F.col("text"))).otherwise(F.col("text"))
    said = said.withColumn("shown", shown)
    escaped = _turn(F.col("role"), F.col("shown"), escape(F.col("role")))
    said = said.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.when(F.col("conflict"), escaped).otherwise(F.col("plain")).alias("out"),
        F.length("shown").alias("n_shown"),
    ).withColumn("n_out", F.length("out"))

    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = F.sum("n_out").over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = said.withColumn("place", F.row_number().over(order)).withColumn("upto", upto)
    # An assistant's text starts behind "<s>".
    span = F.struct(
        (F.col("upto") - F.col("n_out") + 4).cast("int").alias("start"),
        F.col("n_shown").alias("length"),
    )
    packed = F.struct(
        "place", "out", "role", "text", F.when(F.col("role") == ASSISTANT, span).alias("span")
    )
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(packed)).alias("turns"))
    spans = F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull())
    made = grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["out"]), "").alias("formatted"),
        spans.alias("loss"),
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"),
    )
    return made.withColumn("parsed", parse(F.col("formatted"))).select(
        "conv_id",
        "formatted",
        "loss",
        "parsed",
        F.coalesce(F.col("parsed") == F.col("source"), F.lit(False)).alias("identical"),
    )


def digests(made: DataFrame) -> DataFrame:
    """What the formatted strings and loss masks hold, read back from them."""
    texts = F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    # A long string is cut up once, so that no span is looked up from its beginning.
    cuts = F.sequence(F.lit(0), F.expr(f"(greatest(length(formatted), 1) - 1) div {CUT}"))
    parts = F.transform(cuts, lambda i: F.substring("formatted", (i * CUT + 1).cast("int"), F.lit(CUT)))

    def said(parts, s):
        first, last = (F.floor((at - 1) / CUT).cast("int") for at in (s["start"], s["start"] + s["length"]))
        around = F.array_join(F.slice(parts, first + 1, last - first + 1), "")
        return unescape(F.substring(around, F.pmod(s["start"] - 1, F.lit(CUT)) + 1, s["length"]))

    learned = _bound(parts, lambda p: F.array_join(F.transform("loss", lambda s: said(p, s)), ""))
    return made.withColumn("learned", learned).select(
        "conv_id",
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(F.array_join(texts, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
