"""Product codes of vectors: one byte per part, from integer codebooks trained over all rows.

The nearest entry of a part is found by Orchard's search: every entry keeps the others sorted by
their distance from it. A query at some entry walks that entry's list and jumps to the list of the
first entry that is nearer, marks what it has visited, and ends where the list is farther off than
twice the query's own distance: no entry beyond can be nearer, or as near, by the triangle
inequality. All arithmetic is on integers, so ties are real ties; they go to the lower index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from surveyscore.llm.batches import pieces, released
from surveyscore.llm.store import store

PARTS = 16
ENTRIES = 64  # at most 64, the bits of a mark
ROUNDS = 2
SCALE = 256
LARGEST = 2**24  # a scaled component beyond this could make squared distances leave 64 bits
TOGETHER = 4_096  # rows searched at a time


class Orchard:
    """Nearest entries of one part's codebook: an array (entries, width) of integers."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = squared(entries[:, None, :] - entries[None, :, :])
        np.fill_diagonal(apart, -1)  # an entry comes first in its own list, and is left out
        self.lists = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.lists, axis=1)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each query's nearest entry."""
        n, steps = len(queries), self.lists.shape[1]
        at = np.zeros(n, np.int64)  # the entry whose list is walked: the nearest one so far
        own = squared(queries - self.entries[0])
        seen = np.ones(n, np.uint64)
        place = np.zeros(n, np.int64)
        live = np.arange(n if steps else 0)
        while len(live):
            here, k = at[live], place[live]
            go = self.apart[here, k] <= 4 * own[live]  # squares: twice the distance
            live, here, k = live[go], here[go], k[go]
            other = self.lists[here, k]
            mark = np.uint64(1) << other.astype(np.uint64)
            new = (seen[live] & mark) == 0
            seen[live] |= mark
            place[live] = k + 1
            fresh, other = live[new], other[new]
            d = squared(queries[fresh] - self.entries[other])
            nearer = (d < own[fresh]) | ((d == own[fresh]) & (other < at[fresh]))
            jump, other, d = fresh[nearer], other[nearer], d[nearer]
            at[jump], own[jump], place[jump] = other, d, 0
            live = live[place[live] < steps]
        return at, own


def squared(difference: np.ndarray) -> np.ndarray:
    return np.einsum("...i,...i->...", difference, difference)


def scaled(column: pa.Array, parts: int) -> np.ndarray:
    """Vectors of one length as integers, (rows, parts, width)."""
    if not len(column):
        return np.zeros((0, parts, 0), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * SCALE)
    if len(whole) and np.abs(whole).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST // SCALE} have no code")
    return whole.astype(np.int64).reshape(len(column), parts, -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str, carried: list[str]) -> DataFrame:
    """Rows (id, vector, carried columns) whose vector has all its components, each a finite number."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(v.isNotNull() & fine).select(F.col(id_col).alias("id"), v.alias("vector"),
                                                      *[F.col(c).alias(f"carried_{k}") for k, c in enumerate(carried)])


def searched(books: np.ndarray, batches: Iterator[pa.RecordBatch]):
    """Per piece of a batch: the piece, its integers, and index and distance (rows, parts)."""
    tables = [Orchard(book) for book in books]
    for batch in batches:
        for piece in pieces(batch, TOGETHER):
            x = scaled(piece.column(1), len(books))
            found = [t.nearest(x[:, p]) for p, t in enumerate(tables)]
            yield piece, x, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def improve(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round: each used entry becomes the floored mean of its parts.

    Every task adds up its own rows; sums, as many as there are entries, are added by Spark.
    """
    parts, entries, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for _, x, index, _ in searched(shared.value, batches):
            for p in range(parts):
                count[p] += np.bincount(index[:, p], minlength=entries)
                np.add.at(total[p], index[:, p], x[:, p])
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "n": pa.array(count[p, e], pa.int64()),
            "sums": pa.array(list(total[p, e]), pa.list_(pa.int64()))})

    moved = rows.mapInArrow(released(run), "part int, entry int, n long, sums array<long>")
    added = moved.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[
        F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)])
    out = books.copy()
    for r in added.collect():  # at most one row per entry of a codebook
        out[r[0], r[1]] = [s // r[2] for s in r[3:]]
    shared.destroy()
    return out


def start(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """First codebooks: the vectors of the least ids, ties by vector, null ids last; None without rows."""
    order = rows.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector")
    least = order.first()
    if least is None:
        return None
    length = len(least[0])
    if length % parts:
        raise ValueError(f"vectors of length {length} cannot be cut into {parts} equal parts")
    first = order.where(F.size("vector") == length).limit(entries).collect()
    cut = scaled(pa.array([r[0] for r in first], pa.list_(pa.float64())), parts)
    return np.ascontiguousarray(cut.transpose(1, 0, 2))


def assign(rows: DataFrame, books: np.ndarray, id_type: T.DataType, id_col: str, carried: list[str]) -> DataFrame:
    fields = [T.StructField(id_col, id_type)]
    fields += [T.StructField(c, rows.schema[f"carried_{k}"].dataType) for k, c in enumerate(carried)]
    schema = T.StructType([*fields, T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    arrow = to_arrow_schema(schema)
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        for piece, _, index, apart in searched(shared.value, batches):
            code = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(index.shape[1]), len(index), [None, pa.py_buffer(index.astype(np.uint8).tobytes())])
            columns = [piece.column(0), *piece.columns[2:], code.cast(pa.binary()), pa.array(apart.sum(axis=1), pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(released(run), schema)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", carried: tuple[str, ...] = (),
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """Code and error of every usable vector, and the codebooks (parts, entries, width), trained on all of them.

    Rows with a null vector, or one that holds null or non-finite components, are dropped, and so are
    vectors of another length than that of the least id, which no entry can be compared with. The
    others give one row each: the id, ``carried`` columns, code (binary, one byte per part) and error
    (long). The length must be a multiple of ``parts`` and components within ``LARGEST`` / ``SCALE``;
    else this raises. Null ids come after all others among the first entries. Rows of one id are coded
    each for itself; fewer rows than ``entries`` make fewer entries. Without usable rows the result is
    empty and the codebooks are None. Only codebooks, of fixed size, pass the driver.
    """
    rows = store(usable(vectors, id_col, vector_col, list(carried)), "vectors")
    books = start(rows, parts, entries)
    if books is None:
        books_or_none, books = None, np.zeros((parts, 1, 0), np.int64)
    else:
        rows = rows.where(F.size("vector") == books.shape[0] * books.shape[2])
        for _ in range(rounds):
            books = improve(rows, books)
        books_or_none = books
    return assign(rows, books, vectors.schema[id_col].dataType, id_col, list(carried)), books_or_none


def decompress(codes: DataFrame, books: np.ndarray, id_col: str = "vec_id", code_col: str = "code") -> DataFrame:
    """The vector that each code stands for: the id and vector (array<double>)."""
    source = codes.select(F.col(id_col).alias("id"), F.col(code_col).alias("code"))
    schema = T.StructType([T.StructField(id_col, source.schema["id"].dataType), T.StructField("vector", T.ArrayType(T.DoubleType()))])
    arrow = to_arrow_schema(schema)
    shared = codes.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        table, part = shared.value / SCALE, np.arange(len(shared.value))
        for batch in batches:
            index = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, len(part))
            vectors = pa.array(list(table[part, index].reshape(len(index), -1)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([batch.column(0), vectors], arrow)], schema=arrow)

    return source.mapInArrow(released(run), schema)


def fingerprint(books: np.ndarray | None) -> str:
    """Digest of all entries: decimal components by part, entry and place, joined by commas."""
    values = [] if books is None else books.reshape(-1).tolist()
    return hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()
