"""Screening and storing uploaded files."""

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.files import clean_filename, file_extension
from inkwell.operators.validate import OK

# The file types that may be uploaded.
ALLOWED_EXTENSIONS = ["txt", "pdf", "png", "jpg", "jpeg", "gif"]


def upload_screen(uploads: DataFrame, allowed: Collection[str] = ALLOWED_EXTENSIONS) -> DataFrame:
    """Add `outcome` for the file name `fn`: the reason it is refused, or ok."""
    name = F.col("fn")
    accepted = F.coalesce(file_extension(name).isin(*allowed), F.lit(False))
    return uploads.withColumn(
        "outcome",
        F.when(name.isNull(), "No file part")
        .when(name == "", "No selected file")
        .when(accepted, OK)
        .otherwise("file type not allowed"),
    )


def _last_of_each_name(screened: DataFrame, *columns: str) -> DataFrame:
    """The accepted file of each clean name whose `columns` come last in order."""
    return (
        screened.filter(F.col("outcome") == OK)
        .groupBy(clean_filename(F.col("fn")).alias("clean"))
        .agg(F.max(F.struct(*columns)).alias("last"))
        .select("clean", "last.*")
    )


def store_uploads(screened: DataFrame) -> DataFrame:
    """What is stored in the end: the last accepted file, by doc_id, of each clean name."""
    return _last_of_each_name(screened, "doc_id", "n_chars")


def store_uploaded_files(screened: DataFrame) -> DataFrame:
    """clean, arrived, fn, n_bytes and digest of what is stored in the end, from screened rows of
    scan_uploaded_files: of each clean name the file that arrived last, by name if at once."""
    return _last_of_each_name(screened, "arrived", "fn", "n_bytes", "digest")
