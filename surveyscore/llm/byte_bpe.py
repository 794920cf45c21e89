"""Byte-level BPE: ids and offsets of whole texts, and ids back to bytes.

The vocabulary is a file of ranks over bytes. The ``tokenizers`` library works on characters, so
each byte is written as one printable character by a fixed table; decoding reverses the table. A
character of several bytes may be split between tokens: offsets then name the whole character for
each of its tokens, and decoding joins bytes before it reads characters.
"""

from __future__ import annotations

import base64
import os
import uuid
from array import array
from itertools import accumulate, compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from surveyscore.llm.batches import once_per_worker, pieces, released, text_list

LONGEST = 48  # characters of a match that is kept in a worker's cache
CACHED = 160_000  # entries of each of the two generations of a worker's cache


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from lines of base64 and rank; a vocabulary of fixed size."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def byte_characters() -> list[str]:
    """One printable character per byte: itself where Latin-1 prints it, else from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def build_encoder(tokens: list[bytes]):
    """A library tokenizer that merges the adjacent pair whose joined bytes have the least rank.

    Every way to split a token in two known tokens is a merge, in the order of the joined rank.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, models, pre_tokenizers

    table = byte_characters()
    names = ["".join(table[b] for b in token) for token in tokens]
    vocab = {name: i for i, name in enumerate(names)}
    merges = [(n[:i], n[i:]) for n in names for i in range(1, len(n)) if n[:i] in vocab and n[i:] in vocab]
    encoder = Tokenizer(models.BPE(vocab, merges, ignore_merges=True))
    encoder.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return encoder


class Encoder:
    """Ids of texts: the library sees a distinct match of the pattern once, as long as it recurs.

    The cache has two generations. Matches found or met again go to the young one; when that is
    full it becomes the old one, and what has not been met since the last change is given up.
    """

    def __init__(self, tokens: list[bytes], pattern: str):
        self.library, self.split = build_encoder(tokens), regex.compile(pattern).findall
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int32)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.table: list[bytes] = []

    def back(self) -> list[bytes]:
        """Bytes by token id, read from the library's own vocabulary."""
        if not self.table:
            vocabulary = self.library.get_vocab()
            self.table = byte_table(sorted(vocabulary, key=vocabulary.get))
        return self.table

    def learn(self, new: list[str]) -> list[bytes]:
        return [array("i", e.ids).tobytes() for e in self.library.encode_batch_fast(new, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.young) > CACHED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        split = [self.split(t) for t in texts]
        found = [list(map(young.get, ws)) for ws in split]
        missing = set()
        for ws, ids in zip(split, found):
            missing.update(compress(ws, map(not_, ids)))
        new = []
        for w in missing:
            ids = old.get(w)
            if ids is None:
                new.append(w)
            else:
                young[w] = ids
        young.update(zip(new, self.learn(new)))
        for ws, ids in zip(split, found):
            for k in list(compress(range(len(ws)), map(not_, ids))):
                ids[k] = young[ws[k]]
        for w in new:
            if len(w) > LONGEST:
                del young[w]
        return [np.frombuffer(b"".join(ids), dtype=np.int32) for ids in found]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Start and end of each token in code points, and how many tokens cut a character."""
        ends = np.cumsum(self.sizes[ids], dtype=np.int64)
        starts = ends - self.sizes[ids]
        if text.isascii():
            return starts, ends, 0
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        first = np.append((raw & 0xC0) != 0x80, True)  # byte -> does a character begin here
        begun = np.cumsum(first)  # characters begun up to and including this byte
        cut = ~first[starts] | ~first[ends]
        return begun[starts] - 1, begun[ends - 1], int(cut.sum())


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           offsets: bool = True, decoded: bool = False) -> DataFrame:
    """Token ids of every whole text; special strings are ordinary text.

    Returns one row per input row: the id, ids array<int>, n_split (tokens that begin or end
    inside a character) and, unless ``offsets`` is off, starts and ends array<int> in code points;
    with ``decoded`` also the bytes that ``decode`` gives for the ids, worked out in the same pass.
    A null or empty text has no ids. Null ids, repeated rows and an empty table pass through.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks), pattern))
    ints = T.ArrayType(T.IntegerType())
    fields = [T.StructField(id_col, source.schema["id"].dataType), T.StructField("ids", ints),
              T.StructField("n_split", T.LongType())]
    if offsets:
        fields += [T.StructField("starts", ints), T.StructField("ends", ints)]
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    key = uuid.uuid4().hex

    def run(batches):
        encoder = once_per_worker(key, lambda: Encoder(*shared.value))
        for batch in batches:
            for piece in pieces(batch):
                texts = text_list(piece.column(1))
                ids = encoder.encode(texts)
                found = [encoder.offsets(t, i) for t, i in zip(texts, ids)]
                columns = [piece.column(0), lists(ids), pa.array([n for _, _, n in found], pa.int64())]
                if offsets:
                    columns += [lists([s for s, _, _ in found]), lists([e for _, e, _ in found])]
                if decoded:
                    table = encoder.back()
                    columns.append(pa.array([b"".join(map(table.__getitem__, i.tolist())) for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return source.mapInArrow(released(run), schema)


def lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    values = np.concatenate([np.zeros(0, np.int32), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def decode(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes that ids stand for: one row per input row with the id and decoded (binary).

    Null ids, or an empty array, give no bytes; an id outside the vocabulary raises. Bytes need
    not be whole characters; ``decode_text`` reads those of whole texts.
    """
    source = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    schema = T.StructType([T.StructField(id_col, source.schema["id"].dataType),
                           T.StructField("decoded", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        table = byte_table(written(shared.value))
        for batch in batches:
            for piece in pieces(batch):
                sizes = [n or 0 for n in pc.list_value_length(piece.column(1)).to_pylist()]
                ids = piece.column(1).flatten().to_pylist()
                if ids and min(ids) < 0:
                    raise ValueError("negative token id")
                parts = list(map(table.__getitem__, ids))
                ends = list(accumulate(sizes))
                texts = [b"".join(parts[e - n:e]) for n, e in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).cast(arrow.field(0).type), pa.array(texts, pa.binary())], schema=arrow)

    return source.mapInArrow(released(run), schema)


def byte_table(names: list[str]) -> list[bytes]:
    """The bytes of each token: its characters taken back through the byte table."""
    back = {c: bytes([b]) for b, c in enumerate(byte_characters())}
    return [b"".join(back[c] for c in name) for name in names]


def written(tokens: list[bytes]) -> list[str]:
    """Tokens as the library's character strings."""
    table = byte_characters()
    return ["".join(table[b] for b in token) for token in tokens]


def decode_text(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """As ``decode``, with the bytes read as UTF-8; bytes that are no character give U+FFFD."""
    return decode(encoded, ranks, id_col, ids_col).select(
        id_col, F.make_valid_utf8(F.col("decoded").cast("string")).alias("text"))
