"""Texts in Arrow batches: bounded pieces in, one output row per input row."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PIECE_ROWS = 256  # rows handled at a time inside a task: bounds a worker's memory


_made: dict = {}


def once_per_worker(key: str, make: Callable):
    """A value made once in each Python worker, such as a tokenizer. Only the latest is kept."""
    if key not in _made:
        _made.clear()
        _made[key] = make()
    return _made[key]


def forget() -> None:
    """Give up what this worker keeps for operators whose turn is over."""
    _made.clear()


def released(run: Callable) -> Callable:
    """A batch function that hands memory back when its task ends: workers live on, idle or reused."""

    @wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim is not None:
                trim(0)

    return wrapped


def pieces(batch: pa.RecordBatch, rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def text_list(column: pa.Array) -> list[str]:
    """Texts of a column; null is the empty text."""
    return [t or "" for t in column.to_pylist()]


def text_bytes(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """The UTF-8 of all texts of a column in a row, and where each begins and the last ends; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = data.to_pybytes()[at[0]:at[-1]] if data is not None else b""
    return raw, at - at[0]


def map_texts(docs: DataFrame, id_col: str, text_col: str, columns: str,
              prepare: Callable[[], Callable[[list[str]], list]], keep_text: bool = False) -> DataFrame:
    """One row per input row: the id, then ``columns`` (DDL) computed from the text.

    ``prepare`` runs once per task and returns a function from a list of texts to one list or
    array per column. ``keep_text`` puts the text after the id.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    own = T.StructType.fromDDL(columns)
    kept = [T.StructField("text", T.StringType())] if keep_text else []
    schema = T.StructType([T.StructField(id_col, source.schema["id"].dataType), *kept, *own.fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        work = prepare()
        for batch in batches:
            for piece in pieces(batch):
                out = work(text_list(piece.column(1)))
                arrays = [c.cast(f.type) for c, f in zip(piece.columns[:1 + keep_text], arrow)]
                arrays += [pa.array(v, type=f.type) for v, f in zip(out, list(arrow)[1 + keep_text:])]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return source.mapInArrow(released(run), schema)
