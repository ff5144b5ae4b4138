"""The folders of a table, through the file system that Spark reads them with."""

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _located(spark, path)
    return files.exists(place)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder has ended."""
    return exists(spark, f"{path}/_SUCCESS")


def numbered(spark: SparkSession, path: str, label: str) -> list[int]:
    """The numbers of the folders `label`=number in a folder, ascending; none if it isn't there."""
    files, place = _located(spark, path)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place) if status.isDirectory()]
    return sorted(int(name[len(label) + 1 :]) for name in names if name.startswith(f"{label}="))


def remove(spark: SparkSession, path: str) -> None:
    files, place = _located(spark, path)
    files.delete(place, True)
