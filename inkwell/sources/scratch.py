"""Tables written once and read back, in the folder every executor shares."""

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="inkwell-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, under the cluster's spark.checkpoint.dir.

    A local session without that setting gets a temporary folder; a cluster
    session without it is refused, since executors could not see such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    return f"{root.rstrip('/')}/inkwell/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, label: str) -> DataFrame:
    """Write `df` and read it back, so that every later use sees the same rows."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
