"""Groups of a sorted partition, read batch by batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows that agree on the first ``keys`` columns (integers without nulls), one batch per group.

    The partition must be sorted by these columns. At most one group and one batch are held.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)])
        starts = np.flatnonzero((table[:, 1:] != table[:, :-1]).any(axis=0)) + 1
        if held and any(held[0].column(k)[0].as_py() != int(table[k, 0]) for k in range(keys)):
            yield pa.concat_batches(held)
            held = []
        for a, b in zip([0, *starts], [*starts, batch.num_rows]):
            if a and held:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.concat_batches(held)


def by_group(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a group in one partition, next to each other."""
    return frame.repartition(*keys).sortWithinPartitions(*keys)
