"""What several operators share: reading tables, word counts, folds."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """The fold kept for evaluation: crc32 of the id as text is divisible by 5. A NULL id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def packed(df: DataFrame) -> Column:
    """All columns as one named `row`, so that none clashes with what is joined to them."""
    return F.struct(*(F.col(f"`{name}`") for name in df.columns)).alias("row")


def text_key(text: Column) -> Column:
    """128 bits of a text; tells apart rows that share an id. NULL counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))
