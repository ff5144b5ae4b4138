"""From raw documents to a training mix: each stage works on what the one before has kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again.
The first four return the columns of the documents; the last adds how much of each document
the mix takes.

Cases, by the stage that decides: a NULL or empty text is scored like any other by `quality`, has no
line that could go, and is one class with the other texts without words for `near_duplicates`, of which one
stays; it has no passage, and the mix, which takes no words of it, leaves it out. A NULL id is an id
of its own that comes after all others. Rows that repeat id and text get the same verdict until
`near_duplicates` keeps one of them; rows that repeat an id with another text are other documents.
Ties go to the smaller id. Texts are worked off whole. An empty table passes through all
stages as one. Further columns are kept, whatever their names, up to the mix, which has its own.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import decontaminate, line_dedup, mixing, near_dedup, quality_rank
from inkwell.llm.common import packed, table, text_key
from inkwell.sources.scratch import freeze


def _chosen(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of `docs` whose id and text are in `wanted` (doc_id, key)."""
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (text_key(F.col("row.text")) == F.col("key"))
    return docs.select(packed(docs)).join(wanted.select("doc_id", "key").distinct(), same, "left_semi").select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    scored = quality_rank.quality_scores(docs, table(spark, sf_dir, "labels"))
    return _chosen(docs, freeze(scored, "scores").where(F.col("predicted") == 1))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go, and documents of which nothing is left; n_chars is the
    length of the text that is left."""
    found = freeze(line_dedup.similar_lines(docs), "verdicts")
    return line_dedup.remove_lines(docs, found).withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: that with the smallest id."""
    found = freeze(near_dedup.near_duplicates(docs).where("stays"), "classes")
    # Rows that repeat id and text are one document.
    kept = _chosen(docs, found)
    once = kept.select(packed(kept), "doc_id", text_key(F.col("text")).alias("key")).dropDuplicates(["doc_id", "key"])
    return once.select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    found = freeze(decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")), "contamination")
    return _chosen(docs, found.where(F.col("n_hit") == 0))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, and of it the documents it takes anything of."""
    return mixing.mix(docs).where(F.col("taken") > 0)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
]

# Learned scores and consistent sampling can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
