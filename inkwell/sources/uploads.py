"""Reading the tab-separated amount files people upload."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.schemas import UPLOADED_AMOUNTS


def read_upload_tsv(spark: SparkSession, path: str) -> DataFrame:
    """bill_id and amount of every line; a cell that is not a number is NULL."""
    return spark.read.csv(path, sep="\t", schema=UPLOADED_AMOUNTS, mode="PERMISSIVE")


def parse_upload_line(line: Column) -> Column:
    """The same two cells as a struct, for lines that are already in a column."""
    return F.from_csv(
        line, UPLOADED_AMOUNTS.simpleString()[len("struct<") : -1].replace(":", " "),
        {"sep": "\t", "mode": "PERMISSIVE"},
    )


def bad_cells(amounts: DataFrame) -> DataFrame:
    """How many lines were read and how many cells of each column held no number."""
    return amounts.agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("bill_id").isNull()).alias("bad_ids"),
        F.count_if(F.col("amount").isNull()).alias("bad_amounts"),
    )


def scan_uploaded_files(spark: SparkSession, path: str) -> DataFrame:
    """fn, arrived, n_bytes and digest of every file below a folder that isn't empty; Spark lists no
    empty files.

    The digest is taken where the file is read, so that contents go no further; a file is one row
    in its task, as long as it is.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.substring_index("path", "/", -1).alias("fn"),
        F.col("modificationTime").alias("arrived"),
        F.col("length").alias("n_bytes"),
        F.sha2("content", 256).alias("digest"),
    )
