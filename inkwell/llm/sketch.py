"""A counting sketch of fixed size over all texts: how many items fell into each cell."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from inkwell.llm.features import pieces
from inkwell.sources.scratch import freeze

BLOCK = 1 << 12  # cells in a row of the partial sketches


def count_cells(
    texts: DataFrame, bits: int, cells_of: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> tuple[np.ndarray, int]:
    """Counts of the 2**bits cells and the number of rows, over all of `texts` (text). Every task
    sends its used blocks; the sum, of a fixed size, comes back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents = np.zeros(1 << bits, dtype=np.int64), 0
        for batch in batches:
            documents += batch.num_rows
            for data, offsets in pieces(batch.column(0)):
                total += np.bincount(cells_of(data, offsets), minlength=len(total))
        used = [i for i in range(0, len(total), BLOCK) if total[i : i + BLOCK].any()]
        blocks = [total[i : i + BLOCK].astype("<u4").tobytes() for i in used]
        yield pa.record_batch(
            {
                "block": pa.array([-1, *(i // BLOCK for i in used)], pa.int32()),
                "counts": pa.array([np.array([documents], "<u4").tobytes(), *blocks], pa.binary()),
            }
        )

    def add(block: pd.DataFrame) -> pd.DataFrame:
        rows = [np.frombuffer(c, "<u4").astype("<i8") for c in block["counts"]]
        return pd.DataFrame({"block": [block["block"].iloc[0]], "counts": [sum(rows).tobytes()]})

    partial = texts.select("text").mapInArrow(count, "block int, counts binary")
    summed = freeze(partial.groupBy("block").applyInPandas(add, "block int, counts binary"), "sketch")
    total, documents = np.zeros(1 << bits, dtype=np.int64), 0
    for row in summed.collect():
        counts = np.frombuffer(row["counts"], "<i8")
        if row["block"] < 0:
            documents = int(counts[0])
        else:
            total[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = counts
    return total, documents
