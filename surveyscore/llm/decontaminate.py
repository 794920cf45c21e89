"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

Texts are normalised byte by byte (A-Z to lower case, every other ASCII character that is no digit
or letter to a blank), so a position in the normalised text is a position in the original one. Each
document is scanned once; the words inside any window are its hits.
"""

from __future__ import annotations

import string
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from surveyscore.llm.batches import once_per_worker, pieces, released
from surveyscore.llm.store import store

WINDOW = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value: what a word is, after lower-casing A-Z
MAX_WINDOWS = 40_000  # windows of one automaton, some 150 MB in a worker; more take further scans
MAX_BYTES = 8_000_000  # likewise, bytes of its windows

_KEEP = (string.ascii_letters + string.digits).encode() + bytes(range(128, 256))
_NORMAL = bytes(ord(chr(b).lower()) if b in _KEEP and b < 128 else b if b in _KEEP else 32 for b in range(256))


def words_column(text):
    """Words of a text column as an array, by SQL functions."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def windows(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows with the number of the set of items that hold them, and the sets' members.

    Returns stored (window, items) and (items, item). Sets are told apart by their size and two
    64-bit digests, and read off one of their windows, so that no list of items is ever built, and
    a passage that many items share is listed once. Items without an id are in no set.
    """
    texts = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             words_column(F.col(text_col).cast("string")).alias("words"))
    first = f"sequence(1, greatest(1, size(words) - {size - 1}))"
    held = store(texts.where("size(words) > 0").select(
        "item", F.expr(f"explode(transform({first}, i -> array_join(slice(words, i, {size}), ' ')))").alias("window")).distinct(), "held")
    digest = lambda *c: F.bit_xor(F.when(F.col("item").isNotNull(), F.xxhash64(*c, "item")))
    found = store(held.groupBy("window").agg(digest().alias("a"), digest(F.lit(1)).alias("b"), F.count("item").alias("n")), "windows")
    sets = store(found.where("n > 0").groupBy("a", "b", "n").agg(F.min("window").alias("one"))
                 .withColumn("items", F.monotonically_increasing_id()), "item-sets")
    numbered = found.join(sets.drop("one"), ["a", "b", "n"], "left").select("window", "items")
    members = held.where("item is not null").join(sets.select(F.col("one").alias("window"), "items"), "window").select("items", "item")
    return store(numbered, "numbered"), store(members, "members")


def build_automaton(rows):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for window, items in rows:
        automaton.add_word(f" {window} ".encode().decode("latin-1"), (window.count(" ") + 1, items))
    automaton.make_automaton()
    return automaton


def normalise(text: str) -> bytes:
    """Same length as the text's UTF-8 bytes."""
    return text.encode().translate(_NORMAL)


def scan(automaton, normal: bytes):
    """Number of words, covered word indexes and item sets of one normalised text."""
    words = normal.split()
    if not words or not len(automaton):
        return len(words), None, set()
    packed = b" %s " % b" ".join(words)
    found = list(automaton.iter(packed.decode("latin-1")))
    if not found:
        return len(words), None, set()
    blanks = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32)
    last = np.searchsorted(blanks, [end for end, _ in found])  # words before the closing blank
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, last - [n for _, (n, _) in found], 1)
    np.add.at(cover, last, -1)
    return len(words), np.cumsum(cover)[:-1] > 0, {items for _, (_, items) in found}


def word_offsets(text: str, normal: bytes) -> np.ndarray:
    """Start and end of each word in the original text, in code points: an array of two columns."""
    inside = np.concatenate([[False], np.frombuffer(normal, np.uint8) != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begun = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
    return np.concatenate([[0], begun])[edges].reshape(-1, 2)


def runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of True as (first, past the last)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return [(int(a), int(b)) for a, b in edges.reshape(-1, 2)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW,
                       max_windows: int = MAX_WINDOWS, keep_text: bool = False, with_items: bool = True) -> DataFrame:
    """Words of documents that lie inside benchmark windows of ``size`` consecutive words.

    An item of fewer words, but not none, is one window. Returns one row per input row: the id,
    n_words, n_hit, items (sorted texts of the item ids whose windows occur), spans (runs of hit
    words as start and end in code points of the original text); ``keep_text`` adds the text. Null and empty texts have no
    words; an item without an id marks words and is not listed; repeated items and rows are
    harmless; without benchmark words nothing is hit. ``with_items=False`` leaves items out.

    Windows beyond ``max_windows`` (or ``MAX_BYTES``) go to further automata, each scanned in a
    pass of its own over stored results, so a worker never holds more than one: a benchmark of some
    400 items of 100 words takes one pass, ten times as many items take ten.
    Workers see numbers of item sets only; each distinct list of sets found in documents is then
    joined to its items, once.
    """
    found, members = windows(benchmark, item_col, item_text_col, size)
    parts = window_parts(found, max_windows)
    state = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.expr("cast(null as array<struct<first:int,past:int>>)").alias("hits"),
                        F.expr("cast(array() as array<bigint>)").alias("sets"))
    for part, rows in enumerate(parts):
        state = scan_part(state if part == 0 else store(state, "contamination"), rows, part == len(parts) - 1)
    n_hit = F.expr("aggregate(hits, 0L, (n, h) -> n + h.past - h.first)").alias("n_hit")
    head = [F.col("id").alias(id_col), *([F.col("text")] if keep_text else []), F.col("n_words"), n_hit]
    if not with_items:
        return state.select(*head, "spans")
    state = store(state.select("id", *(["text"] if keep_text else []), "n_words", "hits", "sets", "spans"), "contamination")
    listed = state.where("size(sets) > 0")
    named = listed.select("sets").distinct().select("sets", F.explode("sets").alias("items")).join(members, "items").groupBy(
        "sets").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.expr("cast(array() as array<string>)").alias("items")
    return state.where("size(sets) = 0").select(*head, none, "spans").union(
        listed.join(named, "sets").select(*head, "items", "spans"))


def window_parts(found: DataFrame, max_windows: int) -> list[WindowPart]:
    """Windows in as many parts as the bounds ask for, sizes checked before any is read."""
    n, size = found.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window")), F.lit(0))).first()
    parts = max(1, -(-n // max_windows), -(-size // MAX_BYTES))
    return [WindowPart(found, part, parts) for part in range(parts)]


class WindowPart:
    """The windows of one part, read when its scan is set up."""

    def __init__(self, found: DataFrame, part: int, parts: int):
        self.found = found.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == part)

    def rows(self) -> list[tuple[str, int | None]]:
        return [(r["window"], r["items"]) for r in self.found.toLocalIterator()]


def scan_part(state: DataFrame, part: WindowPart, last: bool) -> DataFrame:
    """Add one automaton's hits; the last pass maps all hits to the original text."""
    shared = state.sparkSession.sparkContext.broadcast(part.rows())
    key = uuid.uuid4().hex
    span = "array<struct<first:int,past:int>>"
    keep = [state.schema["id"]]
    if last:
        schema = T.StructType([*keep, *T.StructType.fromDDL(
            f"text string, n_words long, hits {span}, sets array<bigint>, spans array<struct<start:int,end:int>>").fields])
    else:
        schema = T.StructType([*keep, *T.StructType.fromDDL(f"text string, hits {span}, sets array<bigint>").fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        automaton = once_per_worker(key, lambda: build_automaton(shared.value))
        for batch in batches:
            for piece in pieces(batch):
                rows = [one(automaton, *r) for r in zip(*(piece.column(k).to_pylist() for k in (1, 2, 3)))]
                columns = [piece.column(1), *zip(*rows)]
                if not last:
                    columns = [columns[0], columns[2], columns[3]]
                arrays = [piece.column(0).cast(arrow.field(0).type)]
                arrays += [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                           for c, f in zip(columns, list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    def one(automaton, text, hits, sets):
        normal = normalise(text or "")
        n, hit, found = scan(automaton, normal)
        if hits and hit is None:
            hit = np.zeros(n, bool)
        for h in hits or ():
            hit[h["first"]:h["past"]] = True
        if hit is None:
            return n, [], sets, []
        spans = runs(hit)
        at = word_offsets(text, normal) if last else None
        where = [{"start": int(at[a, 0]), "end": int(at[b - 1, 1])} for a, b in spans] if last else []
        return n, [{"first": a, "past": b} for a, b in spans], sorted({*sets, *found} - {None}), where

    return state.mapInArrow(released(run), schema)
