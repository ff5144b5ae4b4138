"""Submissions that keep arriving as files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def submission_stream(
    spark: SparkSession, glob: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A stream over the parquet files that match `glob`, oldest file first."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(glob)


def delivered_once(stream: DataFrame, late: str, id_col: str = "event_id", time_col: str = "ts") -> DataFrame:
    """The stream without submissions that come again, in the same batch or a later one.

    A copy is known for at least `late`, such as "1 hour", after the newest submission has
    passed its time; ids older than that are forgotten, and rows that come so late are left
    out, so the state stays as large as the submissions of that time. A row without an id is
    kept once; one without a time is left out, as it is behind any time.
    """
    timed = stream.withColumn("_at", F.col(time_col).cast("timestamp")).withWatermark("_at", late)
    return timed.dropDuplicatesWithinWatermark([id_col]).drop("_at")
