"""One query per operator over the given tables, and their SQL twins where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import (
    chat,
    decontaminate,
    importance,
    line_dedup,
    mixing,
    near_dedup,
    quality_rank,
    quality_rules,
    secret_scan,
    spelling,
    suffix_dedup,
    token_file,
    toxicity,
)
from inkwell.llm.common import table
from inkwell.llm.oracles import ORACLES
from inkwell.sources.scratch import scratch_path

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_line_dedup(spark, sf_dir):
    found = line_dedup.similar_lines(table(spark, sf_dir, "documents"))
    n_removed = F.size("removed").cast("long").alias("n_removed")
    removed = F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed")
    return found.select("doc_id", "n_lines", n_removed, removed, "n_links", "n_copies")


@query
def op2_toxicity(spark, sf_dir):
    scored = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.drop("key")


@query
def op3_quality_rules(spark, sf_dir):
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digests(suffix_dedup.repeated_passages(table(spark, sf_dir, "documents")))


@query
def op5_decontamination(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digests(decontaminate.contamination(docs, items))


@query
def op6_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("key")


@query
def op7_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(more)))


@query
def op8_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_secret_scan(spark, sf_dir):
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


@query
def op10_quality_classifier(spark, sf_dir):
    scored = quality_rank.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.drop("key")


@query
def op11_token_file(spark, sf_dir):
    from public_tokenizers import path as tokenizer

    folder = scratch_path(spark, "token-file")
    token_file.encode_corpus(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), folder)
    read = token_file.read_tokens(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op12_spelling(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op13_importance(spark, sf_dir):
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
