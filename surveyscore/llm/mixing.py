"""Distributed gradient updates by parameter mixing.

Weights are a few tables of fixed size. In each round every task starts from the same tables, takes
gradient steps through its own rows, and returns how far it moved, with a count of updates for each
table row. Moves are rows of a frame, one for each block of table rows that a task touched; Spark
brings a block's moves together, and they are averaged by their counts one after the other, so a
table row is moved by the tasks that saw it. No task holds more than one set of tables and a block,
and the driver only one set of tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from surveyscore.llm.batches import forget, released

BLOCK = 1024  # table rows whose moves travel together
MOVES = "name int, block int, task int, moves binary, counts binary"
Tables = dict[str, np.ndarray]


def moved(moves: Tables, counts: Tables, task: int) -> Iterator[pa.RecordBatch]:
    """The blocks that were touched, as ``MOVES``."""
    for k, name in enumerate(sorted(moves)):
        for block, at in enumerate(range(0, len(moves[name]), BLOCK)):
            n = counts[name][at:at + BLOCK]
            if n.any():
                x = moves[name][at:at + BLOCK].astype(np.float16)
                yield pa.RecordBatch.from_pydict({
                    "name": pa.array([k], pa.int32()), "block": pa.array([block], pa.int32()), "task": pa.array([task], pa.int32()),
                    "moves": pa.array([x.tobytes()], pa.binary()), "counts": pa.array([n.astype(np.float32).tobytes()], pa.binary())})


def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``MOVES`` in order of blocks: one row for each block, its moves averaged by their counts."""
    key, total, weight = None, None, None

    def row():
        mean = (total / np.maximum(weight, 1e-30)[:, None]).astype(np.float32)
        return pa.RecordBatch.from_pydict({"name": pa.array([key[0]], pa.int32()), "block": pa.array([key[1]], pa.int32()),
                                           "moves": pa.array([mean.tobytes()], pa.binary())})

    for batch in batches:
        for k, block, x, n in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3, 4))):
            counts = np.frombuffer(n, np.float32).astype(np.float64)
            moves = np.frombuffer(x, np.float16).reshape(len(counts), -1).astype(np.float64) * counts[:, None]
            if (k, block) != key:
                if key is not None:
                    yield row()
                key, total, weight = (k, block), moves, counts
            else:
                total += moves
                weight += counts
    if key is not None:
        yield row()


def mix(frame: DataFrame, weights: Tables,
        learn: Callable[[Tables, Iterator[pa.RecordBatch]], tuple[Tables, Tables] | None],
        together: int = 1) -> Tables:
    """One round: weights after all tasks' moves. ``learn`` returns moves and counts, or None.

    A task learns from ``together`` partitions, one after the other, so that moves stay few beside
    what they were learnt from.
    """
    if together > 1:
        frame = frame.coalesce(max(1, -(-frame.rdd.getNumPartitions() // together)))
    shared = frame.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        forget()
        found = learn(shared.value, batches)
        if found is not None:
            yield from moved(*found, TaskContext.get().partitionId())

    moves = frame.mapInArrow(released(run), MOVES).repartition("name", "block").sortWithinPartitions("name", "block", "task")
    out, names = {k: v.copy() for k, v in weights.items()}, sorted(weights)
    for k, block, move in moves.mapInArrow(released(averaged), "name int, block int, moves binary").collect():
        rows = out[names[k]][block * BLOCK:(block + 1) * BLOCK]
        rows += np.frombuffer(move, np.float32).reshape(rows.shape)
    shared.destroy()
    return out
