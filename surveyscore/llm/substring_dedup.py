"""Passages that occur earlier in the corpus, found by parsing documents against an index of it.

Relative Lempel-Ziv parsing, spread over Spark. The reference is the corpus itself. Each document is
cut into phrases by its own content: the windows (20 consecutive words) that share the place of
their least hashed 8-gram, their anchor, form one phrase, so the same passage is cut alike wherever
it stands. The index is the sorted table of phrases by (anchor, phrase, document, place), in blocks
that are its range partitions; a document's phrases fall into the blocks that can hold them, so each
document is parsed against every block without being sent to it. A phrase that is not the first of
its kind is a factor, with the first occurrence as reference; factors that continue each other are
joined from left to right into the longest ones.

Where a passage begins or ends, its outermost phrases are mixed with other text and equal no phrase
of the index, but their anchors recur. There every window of the phrase is looked up by itself, in a
second, smaller index of windows. Both steps together decide every window of every text.

A hot passage is no hot key: blocks are cut by document and place too. Each block reports its first
and last group, a few rows, and those that continue a group of another block are settled by them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from surveyscore.llm.batches import pieces, released, text_bytes
from surveyscore.llm.store import store
from surveyscore.sources.sinks import drop_stored

WINDOW = 20  # words
GRAM = 8  # words of an anchor
BYTES = 1 << 21  # bytes or words handled at a time
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NO_ID = -(2**63)  # stands for a null id, which sorts before all others

# A place in one number: first word of a phrase, a digest of the row's text, windows in the phrase.
VERSION_BITS, COUNT_BITS = 28, 4
START_BITS = VERSION_BITS + COUNT_BITS


def start_of(place):
    return place >> START_BITS


class Rolling:
    """Hashes of stretches of a sequence: differences of prefix sums with a weight per place, modulo 2^64."""

    def __init__(self, seed: int):
        rnd = np.random.default_rng(seed)
        self.letters = rnd.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = (int(rnd.integers(0, 2**61)) << 3) + 3
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]))
                                  for b in (self.base % 2**64, pow(self.base, -1, 2**64)))

    def stretches(self, values: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        self.grow(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[:len(values)], out=sums[1:])
        return (sums[stop] - sums[first]) * self.down[first]


OF_BYTES, OF_WORDS, OF_PHRASES = Rolling(11), Rolling(12), Rolling(13)


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of a hash spread over all others, one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte range of each word of all texts, and each text's first word (and one past the last)."""
    inside = ~SPACE[np.frombuffer(raw, np.uint8)]
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = at[1:] > at[:-1]
    begin[at[:-1][filled]], last[at[1:][filled] - 1] = inside[at[:-1][filled]], inside[at[1:][filled] - 1]
    first = np.flatnonzero(begin)
    return first, np.flatnonzero(last) + 1, np.searchsorted(first, at)


def word_hashes(raw: bytes, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    values, out = np.frombuffer(raw, np.uint8), np.empty(len(first), np.uint64)
    cuts = np.unique(np.searchsorted(first, np.arange(0, len(values) + BYTES, BYTES)))
    for i, j in zip(cuts[:-1], cuts[1:]):
        low, high = first[i], stop[j - 1]
        out[i:j] = OF_BYTES.stretches(OF_BYTES.letters[values[low:high]], first[i:j] - low, stop[i:j] - low)
    return mixed(out)


def least_gram(grams: np.ndarray, width: int) -> np.ndarray:
    """For each place the index of the first least value among the ``width`` that begin there."""
    n = len(grams) - width + 1
    value, index, reach = grams, np.arange(len(grams)), 1

    def joined(shift):
        right = value[shift:] < value[:-shift]
        return np.where(right, value[shift:], value[:-shift]), np.where(right, index[shift:], index[:-shift])

    while 2 * reach <= width:
        value, index = joined(reach)
        reach *= 2
    if reach < width:
        value, index = joined(width - reach)
    return index[:n]


def phrases(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """Phrases of a run of words; ``text`` numbers the text of each word.

    Returns first window, number of windows, anchor hash and phrase hash.
    """
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    at = np.arange(len(hashes) - GRAM + 1)
    grams = mixed(OF_WORDS.stretches(hashes, at, at + GRAM))
    anchor = least_gram(grams, WINDOW - GRAM + 1)
    whole = text[:n] == text[WINDOW - 1:]
    change = np.ones(n, bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    first = np.flatnonzero(change & whole)
    ends = np.append(np.flatnonzero(change | ~whole), n)
    stop = ends[np.searchsorted(ends, first, "right")]
    phrase = mixed(OF_PHRASES.stretches(hashes, first, stop + WINDOW - 1))
    return first, stop - first, grams[anchor[first]], phrase


def word_runs(counts: np.ndarray):
    """Word ranges handled at a time; each overlaps the next by all windows that begin in it."""
    n = int(counts.sum())
    for low in range(0, n, BYTES // 8):
        yield low, min(n, low + BYTES // 8 + WINDOW - 1)


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, doc, version, text): the id as a number, and a digest that tells rows of one id apart."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.coalesce(F.shiftrightunsigned(F.xxhash64(text), 64 - VERSION_BITS), F.lit(0)).alias("version"), text.alias("text"))


ROW = "h long, g long, doc long, place long"


def place(start: np.ndarray, version: np.ndarray, windows) -> np.ndarray:
    return (start << START_BITS) | (version << COUNT_BITS) | windows


def phrase_rows(rows: DataFrame) -> DataFrame:
    """One row per phrase of each text, as ``ROW``."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                doc, version = (piece.column(k).to_numpy() for k in (0, 1))
                raw, at = text_bytes(piece.column(2))
                first, stop, starts = words_of(raw, at)
                hashes, counts = word_hashes(raw, first, stop), np.diff(starts)
                text = np.repeat(np.arange(len(counts)), counts)
                for low, high in word_runs(counts):
                    begin, windows, anchor, phrase = phrases(hashes[low:high], text[low:high])
                    own = text[low:high][begin]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(anchor.view(np.int64)), pa.array(phrase.view(np.int64)), pa.array(doc[own]),
                        pa.array(place(low + begin - starts[own], version[own], windows))], names=["h", "g", "doc", "place"])

    return rows.select("doc", "version", "text").mapInArrow(released(run), ROW)


def window_rows(rows: DataFrame) -> DataFrame:
    """One row per window of the listed phrases, as ``ROW``; ``at`` holds pairs of first and number."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                raw, at = text_bytes(piece.column(2))
                first, stop, starts = words_of(raw, at)
                hashes = word_hashes(raw, first, stop)
                listed = [np.frombuffer(b or b"", np.int64).reshape(-1, 2) for b in piece.column(3).to_pylist()]
                own = np.repeat(np.arange(len(listed)), [len(x) for x in listed])
                begin, windows = np.concatenate([np.zeros((0, 2), np.int64), *listed]).T
                own = np.repeat(own, windows)
                within = np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(begin, windows)
                doc, version = (piece.column(k).to_numpy()[own] for k in (0, 1))
                s = starts[own] + within
                h, g = (mixed(f.stretches(hashes, s, s + WINDOW)).view(np.int64) for f in (OF_WORDS, OF_PHRASES))
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(g), pa.array(doc), pa.array(place(within, version, 1))],
                                                 names=["h", "g", "doc", "place"])

    return rows.select("doc", "version", "text", "at").mapInArrow(released(run), ROW)


REPEAT, EDGE, BORDER = 0, 1, 2
FOUND = "kind int, h long, g long, doc long, place long, ref_doc long, ref_start long"


class Groups:
    """Sorted rows of one block, batch by batch: which repeat an earlier one, and which lie on an edge.

    Held are the first row of the group that is open and its rows that are no repeats: rows at one
    place of one document, each kept once.
    """

    def __init__(self):
        self.held = np.zeros((4, 0), np.int64)  # rows of the open group that are no repeats
        self.first_group, self.shared = True, False  # shared: the group before has the same anchor

    def batch(self, rows: np.ndarray):
        """Rows (4, n) in order: yields (kind, rows, reference rows)."""
        known = self.held.shape[1]
        rows = np.concatenate([self.held, rows], axis=1)
        n = rows.shape[1]
        new = np.ones(n, bool)
        new[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        first = rows[:, heads[group]]
        repeat = (rows[2] != first[2]) | (start_of(rows[3]) != start_of(first[3]))
        once = np.ones(n, bool)  # equal rows in a row count once
        once[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
        fresh = repeat & once
        fresh[:known] = False
        yield REPEAT, rows[:, fresh], first[:, fresh]
        shared = np.zeros(len(heads), bool)  # does a neighbouring group have the same anchor
        same = rows[0, heads[1:]] == rows[0, heads[:-1]]
        shared[1:] |= same
        shared[:-1] |= same
        shared[0] |= self.shared
        closed = ~repeat & once & (group < len(heads) - 1)
        of_first = closed & (group == 0) if self.first_group else np.zeros(n, bool)
        yield BORDER, rows[:, of_first], rows[:, of_first]
        edge = closed & shared[group] & ~of_first
        yield EDGE, rows[:, edge], rows[:, edge]
        if len(heads) > 1:
            self.first_group, self.shared = False, bool(same[-1])
        self.held = rows[:, ~repeat & once & (group == len(heads) - 1)]

    def end(self):
        yield BORDER, self.held, self.held


def repeats(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored outcome, rows that repeat an earlier one, and rows whose anchor other phrases share.

    Rows are sorted into blocks by all their columns, so that equal rows spread over blocks.
    """
    order = ["h", "g", "doc", "place"]
    schema = T.StructType.fromDDL(FOUND)
    arrow = to_arrow_schema(schema)

    def run(batches):
        state = Groups()

        def made(parts):
            for kind, r, ref in parts:
                if not r.shape[1]:
                    continue
                keys = [pa.array(r[k]) if kind == BORDER else pa.nulls(r.shape[1], pa.int64()) for k in (0, 1)]
                refs = [pa.array(ref[2]), pa.array(start_of(ref[3]))] if kind == REPEAT else [pa.nulls(r.shape[1], pa.int64())] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(r.shape[1], kind, np.int32)), *keys, pa.array(r[2]), pa.array(r[3]), *refs], schema=arrow)

        for batch in batches:
            if batch.num_rows:
                yield from made(state.batch(np.stack([c.to_numpy() for c in batch.columns])))
        yield from made(state.end())

    found = store(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(released(run), schema), name)
    borders = found.where(f"kind = {BORDER}").select("h", "g", "doc", "place", 
                                                      F.struct("doc", F.shiftright("place", START_BITS).alias("start")).alias("own"))
    least = borders.groupBy("h", "g").agg(F.min("own").alias("least"))
    late = borders.join(least, ["h", "g"]).where("own > least").select("doc", "place", F.col("least.doc").alias("ref_doc"), F.col("least.start").alias("ref_start"))
    return found, found.where(f"kind = {REPEAT}").select(*late.columns).union(late), found.where(f"kind > {REPEAT}").select("doc", "place")


def per_text(rows: DataFrame, width: int, chain: bool) -> DataFrame:
    """Rows of each text as one: (doc, version, at), ``at`` packed int64 of ``width`` to an entry.

    Entries are sorted by start: start, number of windows, and reference if there is one. With
    ``chain`` an entry that continues the one before, in text and reference, becomes part of it.
    """
    version = F.shiftright("place", COUNT_BITS).bitwiseAND(2**VERSION_BITS - 1).alias("version")
    keyed = rows.select("doc", version, *[c for c in rows.columns if c != "doc"])
    keyed = keyed.repartition("doc", "version").sortWithinPartitions("doc", "version", "place")

    def packed(groups: list[np.ndarray]) -> bytes:
        r = np.concatenate(groups, axis=1)
        once = np.ones(r.shape[1], bool)
        once[1:] = r[2, 1:] != r[2, :-1]
        r = r[:, once]
        out = np.stack([start_of(r[2]), r[2] & (2**COUNT_BITS - 1), *r[3:]])
        if chain:
            ends = out[0] + out[1]
            on = (out[0, 1:] == ends[:-1]) & (out[2, 1:] == out[2, :-1]) & (out[3, 1:] - out[3, :-1] == out[1, :-1])
            heads = np.flatnonzero(np.concatenate([[True], ~on]))
            total = np.add.reduceat(out[1], heads)
            out = out[:, heads]
            out[1] = total
        return out.T[:, :width].tobytes()

    def run(batches):
        held, key = [], None

        def row(at):
            return pa.RecordBatch.from_pydict({"doc": pa.array([k[0] for k, _ in at], pa.int64()),
                                               "version": pa.array([k[1] for k, _ in at], pa.int64()),
                                               "at": pa.array([b for _, b in at], pa.binary())})

        for batch in batches:
            if not batch.num_rows:
                continue
            r = np.stack([c.to_numpy() for c in batch.columns])
            starts = np.flatnonzero((r[:2, 1:] != r[:2, :-1]).any(axis=0)) + 1
            done = []
            for a, b in zip([0, *starts], [*starts, r.shape[1]]):
                here = int(r[0, a]), int(r[1, a])
                if key is not None and here != key:
                    done.append((key, packed(held)))
                    held = []
                key = here
                held.append(r[:, a:b])
            if done:
                yield row(done)
        if held:
            yield row([(key, packed(held))])

    return keyed.mapInArrow(released(run), "doc long, version long, at binary")


def kept_texts(rows: DataFrame, id_col: str, id_type: T.DataType) -> DataFrame:
    """Texts without the words of their factors."""
    factor = "struct<start:long,end:long,ref_id:long,ref_start:long>"
    schema = T.StructType([T.StructField(id_col, id_type)]
                          + T.StructType.fromDDL(f"n_words long, n_removed long, kept string, factors array<{factor}>").fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                raw, at = text_bytes(piece.column(1))
                first, stop, starts = words_of(raw, at)
                listed = [np.frombuffer(b or b"", np.int64).reshape(-1, 4) for b in piece.column(2).to_pylist()]
                own = np.repeat(np.arange(len(listed)), [len(x) for x in listed])
                f = np.concatenate([np.zeros((0, 4), np.int64), *listed]).T.copy()
                ends = f[0] + f[1] + WINDOW - 1
                depth = np.zeros(len(first) + 1, np.int64)
                np.add.at(depth, starts[own] + f[0], 1)
                np.add.at(depth, starts[own] + ends, -1)
                keep = np.cumsum(depth[:-1]) == 0
                text, sizes = without(raw, at, first, stop, starts, keep)
                kept_sum = np.concatenate([[0], np.cumsum(keep)])
                n = np.diff(starts)
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(listed)))]), pa.int32())
                factors = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
                    [pa.array(f[0]), pa.array(ends), pa.array(f[2], mask=f[2] == NO_ID), pa.array(f[3])],
                    names=["start", "end", "ref_id", "ref_start"]))
                kept = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(sizes.tobytes()), pa.py_buffer(text))
                columns = [piece.column(0), pa.array(n), pa.array(n - np.diff(kept_sum[starts])), kept, factors]
                yield pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, arrow)], schema=arrow)

    return rows.select("id", "text", "at").mapInArrow(released(run), schema)


def without(raw: bytes, at: np.ndarray, first: np.ndarray, stop: np.ndarray, starts: np.ndarray, keep: np.ndarray):
    """Kept words of each text joined by one space: their bytes, and the offsets of the texts.

    A word after the first of its text has a blank before it, whose place takes the joining space.
    """
    lead = np.zeros(len(first), bool)  # the first kept word of its text
    kept = np.flatnonzero(keep)
    owner = np.searchsorted(starts, kept, "right")
    lead[kept[np.flatnonzero(np.diff(owner, prepend=-1))]] = True
    change = np.zeros(len(raw) + 1, np.int8)
    begin = first - (keep & ~lead)
    change[begin[keep]] += 1
    change[stop[keep]] -= 1  # often where the next word's space begins, which leaves 0
    inside = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    values = np.where(SPACE[np.frombuffer(raw, np.uint8)], np.uint8(0x20), np.frombuffer(raw, np.uint8))
    sizes = np.concatenate([[0], np.cumsum(inside)]).astype(np.int64)[at]
    return values[inside].tobytes(), sizes


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every whole text without the words of windows that occur earlier in the corpus.

    Returns one row per input row: the id, n_words, n_removed, kept (the remaining words, joined by
    one space) and factors: array of (start, end, ref_id, ref_start), the words covered and where
    an earlier occurrence begins. Factors may overlap by up to a window less one word.

    Words are split at ASCII white space and compared as they are. Earlier means a smaller id, or
    the same id and an earlier word; ids are integers, a null id sorts first. Rows that share an id
    count as one document: equal places are not earlier than each other, so repeated rows lose the
    same words. Null, empty and short texts have no windows; an empty table gives an empty result.
    """
    rows = numbered(docs, id_col, text_col)
    found, whole, edges = repeats(phrase_rows(rows), "phrases")
    at_edges = per_text(edges, 2, chain=False)
    small, single, _ = repeats(window_rows(rows.join(at_edges, ["doc", "version"])), "windows")
    factors = store(per_text(whole.union(single), 4, chain=True), "factors")
    drop_stored(found)
    drop_stored(small)
    return kept_texts(rows.join(factors, ["doc", "version"], "left"), id_col, docs.schema[id_col].dataType)
