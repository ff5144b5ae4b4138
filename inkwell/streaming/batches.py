"""A table that micro-batches add to, one folder per batch, whose old batches are folded.

    batches/batch=7    what batch 7 contributes; a replay of the batch replaces it
    folded/upto=6      all of the batches up to 6, merged
    last/batch=7       a number that goes on from batch to batch

A batch is folded only while a later one runs, when it has been committed and can't be
replayed any more. A fold counts once its write has ended; readers take the newest one and the batches
after it. What a fold has replaced is removed with the fold after it, so that readers
in progress keep their files; with a fold every `every` batches there are never more than
2 * `every` + 1 folders of batches and two folds.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.sources import folders

FOLD_EVERY = 50


class BatchTable:
    def __init__(
        self,
        spark: SparkSession,
        out: str,
        schema: str,
        merge: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        by: Sequence[str] = (),
        every: int = FOLD_EVERY,
    ):
        """`schema` is that of the rows without `batch`; `by` are the columns that folders are made of."""
        self.spark, self.out, self.schema, self.merge, self.by, self.every = spark, out, schema, merge, list(by), every

    def _batch(self, number: int) -> str:
        return f"{self.out}/batches/batch={number}"

    def _fold(self, upto: int) -> str:
        return f"{self.out}/folded/upto={upto}"

    def folds(self) -> list[int]:
        found = folders.numbered(self.spark, f"{self.out}/folded", "upto")
        return [upto for upto in found if folders.is_complete(self.spark, self._fold(upto))]

    def rows(self, before: int | None = None) -> DataFrame:
        """What all batches, or those `before` a batch, have contributed."""
        read, nothing = self.spark.read, self.spark.createDataFrame([], self.schema)
        upto = max((n for n in self.folds() if before is None or n < before), default=-1)
        found = read.schema(self.schema).parquet(self._fold(upto)) if upto >= 0 else nothing
        if not folders.numbered(self.spark, f"{self.out}/batches", "batch"):
            return found
        newer = F.col("batch") > upto
        if before is not None:
            newer &= F.col("batch") < before
        batches = read.schema(f"{self.schema}, batch bigint").parquet(f"{self.out}/batches").filter(newer)
        return found.unionByName(batches.drop("batch"))

    def write(self, rows: DataFrame, batch: int) -> None:
        """Set what a batch contributes, and fold the batches before it when it is time."""
        self._write(rows, self._batch(batch))
        if batch and batch % self.every == 0:
            self.fold(batch)

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").partitionBy(*self.by).parquet(path)

    def fold(self, batch: int) -> None:
        """Merge the batches before `batch` into one folder, and remove what the fold before had replaced."""
        done = self.folds()
        earlier = [upto for upto in done if upto < batch - 1]
        if batch - 1 not in done:
            self._write(self.merge(self.rows(before=batch)), self._fold(batch - 1))
        if not earlier:
            return
        for number in folders.numbered(self.spark, f"{self.out}/batches", "batch"):
            if number <= earlier[-1]:
                folders.remove(self.spark, self._batch(number))
        for upto in earlier[:-1]:
            folders.remove(self.spark, self._fold(upto))

    def written(self, batch: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._batch(batch))

    def last(self, before: int, at_first: int) -> int:
        """The number that the batch before this one has left."""
        left = [n for n in folders.numbered(self.spark, f"{self.out}/last", "batch") if n < before]
        if not left:
            return at_first
        return self.spark.read.schema("last bigint").parquet(f"{self.out}/last/batch={left[-1]}").first()["last"]

    def set_last(self, batch: int, last: int) -> None:
        row = self.spark.createDataFrame([(last,)], "last bigint").coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.out}/last/batch={batch}")
        for number in folders.numbered(self.spark, f"{self.out}/last", "batch"):
            if number < batch - 1:
                folders.remove(self.spark, f"{self.out}/last/batch={number}")
