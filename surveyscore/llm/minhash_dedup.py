"""Near-duplicate texts by MinHash banding.

1. One pass makes, for each text, a hash of its word sequence, its number of distinct shingles and
   a signature: the minima of many universal (multiply-shift) hashes over its whole shingle set.
   Texts of one word sequence become one class.
2. Classes that agree in all rows of a band share a bucket. The leader of a bucket is its class
   with the fullest buckets overall, which is near the middle of a group of near copies. Every
   other class of the bucket is paired with the leader: pairs grow with the rows, whatever the
   bucket's size. A pair is dropped if its signatures rule the similarity out by a wide margin, and
   confirmed on the full shingle sets otherwise.
3. Buckets whose classes then still lie in several components are searched for links that no leader
   shows. Signatures are compared within the bucket, in blocks of bounded size, between components
   only; classes that may still link are gathered into families, and the full sets of a family are
   compared, again in blocks. Both searches pass on a few rows per class, never their pairs.
4. Components by alternating large-star and small-star.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from surveyscore.llm.batches import pieces, released, text_list
from surveyscore.llm.components import connected_components, least_reached, name_rows
from surveyscore.llm.grouped import by_group, sorted_groups
from surveyscore.llm.store import store

SHINGLE = 5
ROWS = 5  # most minima of a band
MOST_BANDS = 64  # beyond it a band takes fewer minima
MISSED = 1e-6  # most probability that a pair at the threshold shares no band
MARGIN = 5.0  # standard deviations below the threshold at which a signature rules a pair out
BLOCK = 512  # classes of a bucket or family that are compared with as many others at a time
SEED = 40_511
BLOOM_BITS = 1 << 26  # most bits of the broadcast filter: 8 MB


def words_of(text: str) -> list[bytes]:
    """Words: runs without blank or ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of a word sequence's shingles, sorted."""
    from xxhash import xxh3_64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    out = np.full(n, min(len(words), size), np.uint64)
    for k in range(min(len(words), size)):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
        out ^= out >> np.uint64(29)
    return np.unique(out * np.uint64(0xBF58476D1CE4E5B9))


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """High 32 bits of the minima of ``factor * x + shift`` modulo 2**64."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at:at + 2048]
        np.minimum(least, (factors[:, None] * part + shifts[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def family(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def banding(percent: int) -> tuple[int, int]:
    """Bands, and minima of a band: all bands miss a pair at the threshold with probability ``MISSED`` at most."""
    for rows in range(ROWS, 0, -1):
        agree = (percent / 100) ** rows
        bands = 1 if agree >= 1 else math.ceil(math.log(MISSED) / math.log1p(-agree))
        if bands <= MOST_BANDS or rows == 1:
            return bands, rows
    raise ValueError("percent must be positive")


def similar(a: str, b: str, percent: int, size: int) -> bool:
    """Whether ``100 * intersection >= percent * union`` of two texts' full shingle sets."""
    return overlap(shingle_hashes(words_of(a), size), shingle_hashes(words_of(b), size), percent)


def overlap(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return bool(both) and 100 * both >= percent * (len(x) + len(y) - both)


def sign(docs: DataFrame, id_col: str, text_col: str, size: int, count: int) -> DataFrame:
    """One row per input row: id, h and g (hash of the word sequence, null without words), n, signature."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([source.schema["id"], *T.StructType.fromDDL("h long, g long, n long, sig binary").fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        factors, shifts = family(count)
        for batch in batches:
            for piece in pieces(batch):
                rows = []
                for text, known in zip(text_list(piece.column(1)), piece.column(0).is_valid().to_pylist()):
                    words = words_of(text)
                    shingles = shingle_hashes(words, size)
                    if not words or not known:
                        rows.append((None, None, len(shingles), None))
                        continue
                    h, g = sequence_hash(words)
                    rows.append((h, g, len(shingles), signature(shingles, factors, shifts).tobytes()))
                arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays([piece.column(0).cast(arrow.field(0).type), *arrays], schema=arrow)

    return source.mapInArrow(released(run), schema)


def sequence_hash(words: list[bytes]) -> tuple[int, int]:
    digest = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def buckets(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(cid, band, key) for each class and band."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 4096):
                sigs = np.stack([np.frombuffer(s, np.uint32) for s in piece.column(1).to_pylist()]).astype(np.uint64)
                keys = np.zeros((len(sigs), bands), np.uint64)
                for r in range(rows):
                    keys = keys * np.uint64(0x9E3779B97F4A7C15) + sigs[:, r:bands * rows:rows] + np.uint64(1)
                    keys ^= keys >> np.uint64(31)
                cids = np.repeat(piece.column(0).to_numpy(), bands)
                yield pa.RecordBatch.from_pydict({
                    "cid": cids, "band": np.tile(np.arange(bands, dtype=np.int32), len(sigs)),
                    "key": keys.ravel().view(np.int64)})

    return classes.select("cid", "sig").mapInArrow(released(run), "cid long, band int, key long")


def crowded(bucketed: DataFrame) -> DataFrame:
    """The rows of buckets that several classes share, with their number."""
    crowds = store(bucketed.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1"), "crowds")
    return store(bucketed.join(crowds, ["band", "key"]).select("cid", "band", "key", "n"), "buckets")


def leader_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): each class with the leaders of its buckets."""
    fullness = store(shared.groupBy("cid").agg(F.sum("n").alias("fullness")), "fullness")
    rows = store(shared.join(fullness, "cid").select("cid", "band", "key", "fullness"), "ranked")
    leaders = store(rows.groupBy("band", "key").agg(F.max(F.struct("fullness", -F.col("cid"))).alias("lead"))
                    .select("band", "key", (-F.col("lead.col2")).alias("b")), "leaders")
    return (rows.join(leaders, ["band", "key"]).where("cid != b")
            .select(F.least("cid", "b").alias("a"), F.greatest("cid", "b").alias("b")).distinct())


def least_agreement(percent: int, count: int) -> int:
    """Equal minima that two sets at the threshold practically always have."""
    p = percent / 100
    return int(max(1, count * p - MARGIN * (count * p * (1 - p)) ** 0.5))


def plausible(pairs: DataFrame, classes: DataFrame, percent: int, count: int) -> DataFrame:
    """Pairs whose signatures do not rule out the similarity."""
    least = least_agreement(percent, count)
    one = classes.select(F.col("cid").alias("a"), F.col("sig").alias("sig_a"))
    two = classes.select(F.col("cid").alias("b"), F.col("sig").alias("sig_b"))

    @F.pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        agree = np.frombuffer(b"".join(x), np.uint32) == np.frombuffer(b"".join(y), np.uint32)
        return pd.Series(agree.reshape(len(x), -1).sum(axis=1) >= least)

    return pairs.join(one, "a").join(two, "b").where(near("sig_a", "sig_b")).select("a", "b")


class Texts:
    """Texts of the classes that pairs ask for, read from the documents when first needed."""

    def __init__(self, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str):
        self.docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
        self.classes = classes

    def of(self, asked: DataFrame) -> DataFrame:
        """(cid, text), stored. Rows are first thinned by a Bloom filter of bounded size."""
        wanted = store(self.classes.join(asked, "cid", "left_semi").select("cid", "id", "h", "g"), "wanted")
        size = 1 << min(max(16 * wanted.count(), 1 << 10).bit_length(), BLOOM_BITS.bit_length() - 1)
        bloom = self.docs.sparkSession.sparkContext.broadcast(bit_table(wanted.select(*marks("id")), size))
        # One Python node: two in a stage would hold two workers a task, which Spark then keeps and deals tasks to in turn.
        named = thinned(self.docs, bloom, size).join(wanted.select("id").distinct(), "id", "left_semi")
        return store(named.join(wanted, ["id", "h", "g"]).select("cid", "text").dropDuplicates(["cid"]), "texts")


def marks(id_col: str) -> list:
    """Where an id stands in a Bloom filter, before its size is taken."""
    return [F.xxhash64(F.lit(k), id_col).alias(f"at{k}") for k in range(4)]


def thinned(docs: DataFrame, bloom, size: int) -> DataFrame:
    """(id, text, h, g) of the rows whose ids the filter lets through."""
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL("h long, g long").fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        table = np.frombuffer(bloom.value, np.uint8)
        for batch in batches:
            near = np.logical_and.reduce([has_bit(table, batch.column(k).to_numpy(), size) for k in range(2, batch.num_columns)])
            for piece in pieces(batch.select([0, 1]).filter(pa.array(near))):
                found = [sequence_hash(words_of(t)) for t in text_list(piece.column(1))]
                arrays = [c.cast(f.type) for c, f in zip(piece.columns, arrow)]
                arrays += [pa.array([x[k] for x in found], pa.int64()) for k in range(2)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select("id", "text", *marks("id")).mapInArrow(released(run), schema)


def bit_table(marks: DataFrame, size: int) -> bytes:
    """A table of ``size`` bits, those of all marks set, from one row for every 64 of them."""
    at = F.explode(F.array(*marks.columns)).alias("at")
    rows = marks.select(at).select(F.col("at").bitwiseAND(F.lit(size - 1)).alias("at"))
    words = rows.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits"))
    table, found = np.zeros(size // 64, "<i8"), words.toArrow()
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table.tobytes()


def has_bit(table: np.ndarray, marks: np.ndarray, size: int) -> np.ndarray:
    at = marks.astype(np.int64).view(np.uint64) & np.uint64(size - 1)
    return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def confirm(pairs: DataFrame, texts: Texts, percent: int, size: int) -> DataFrame:
    """Pairs that hold on the full shingle sets, stored."""
    pairs = store(pairs, "pairs")
    found = texts.of(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct())

    @F.pandas_udf("boolean")
    def holds(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([similar(a, b, percent, size) for a, b in zip(x, y)], dtype=bool)

    one = found.select(F.col("cid").alias("a"), F.col("text").alias("text_a"))
    two = found.select(F.col("cid").alias("b"), F.col("text").alias("text_b"))
    return store(pairs.join(one, "a").join(two, "b").where(holds("text_a", "text_b")).select("a", "b"), "links")


def in_blocks(rows: DataFrame, group: list[str]) -> DataFrame:
    """Each row of a group of ``n`` rows with the pairs (i, j) of blocks it belongs to; own is its block."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(
        F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    dealt = dealt.withColumn("cell", F.explode(cells)).select("*", "cell.i", "cell.j").drop("cell")
    return by_group(dealt, [*group, "i", "j"])


def may_link(sigs: np.ndarray, part: np.ndarray, own: np.ndarray, i: int, j: int, least: int):
    """For each row, later rows of other components whose signatures agree enough.

    In a cell of two blocks only pairs across them are looked at.
    """
    for x in range(len(sigs) - 1):
        rest = np.flatnonzero((part[x + 1:] != part[x]) & ((i == j) | (own[x + 1:] != own[x]))) + x + 1
        if len(rest):
            rest = rest[(sigs[rest] == sigs[x]).sum(axis=1) >= least]
            if len(rest):
                yield x, rest


def families(shared: DataFrame, classes: DataFrame, found: DataFrame, least: int) -> DataFrame:
    """(a, b): links that join classes which may still link, from buckets of several components."""
    part = found.select(F.col("node").alias("cid"), F.col("component").alias("part"))
    rows = store(shared.join(part, "cid", "left").select("cid", F.coalesce("part", "cid").alias("part"), "band", "key"), "parted")
    mixed = store(rows.groupBy("band", "key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n"))
                  .where("low < high").select("band", "key", "n"), "mixed")
    rows = store(rows.join(mixed, ["band", "key"]), "mixed-rows").join(classes.select("cid", "sig"), "cid")
    cells = in_blocks(rows, ["band", "key"]).select("band", "key", "i", "j", "own", "cid", "part", "sig")

    def search(batches):
        for group in sorted_groups(batches, 4):
            i, j = group.column(2)[0].as_py(), group.column(3)[0].as_py()
            own, cids, part = (group.column(k).to_numpy() for k in (4, 5, 6))
            sigs = np.stack([np.frombuffer(s, np.uint32) for s in group.column(7).to_pylist()])
            links = [np.stack([np.full(len(rest), x), rest], 1) for x, rest in may_link(sigs, part, own, i, j, least)]
            if links:
                label = least_reached(len(cids), np.concatenate(links))
                moved = label != np.arange(len(cids))
                yield pa.RecordBatch.from_pydict({"a": cids[moved], "b": cids[label[moved]]})

    return cells.mapInArrow(released(search), "a long, b long")


def family_links(joined: DataFrame, found: DataFrame, texts: Texts, percent: int, size: int, count: int) -> DataFrame:
    """(a, b): links on full sets between components, within families of classes, stored."""
    part = found.select(F.col("node").alias("cid"), F.col("component").alias("part"))
    named = connected_components(joined)
    rows = named.select(F.col("node").alias("cid"), F.col("component").alias("family")).union(
        named.select("component", "component").distinct())
    rows = store(rows.join(part, "cid", "left").select("cid", "family", F.coalesce("part", "cid").alias("part")), "families")
    sizes = store(rows.groupBy("family").agg(F.count("*").alias("n")), "family-sizes")
    rows = store(rows.join(sizes, "family").join(texts.of(rows.select("cid")), "cid"), "family-rows")
    cells = in_blocks(rows, ["family"]).select("family", "i", "j", "own", "cid", "part", "text")
    least = least_agreement(percent, count)

    def search(batches):
        hashes = family(count)
        for group in sorted_groups(batches, 3):
            i, j = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            own, cids, part = (group.column(k).to_numpy().copy() for k in (3, 4, 5))
            sets = [shingle_hashes(words_of(t), size) for t in group.column(6).to_pylist()]
            sigs = np.stack([signature(s, *hashes) for s in sets])
            links = []
            for x, rest in may_link(sigs, part, own, i, j, least):
                for y in rest:
                    if part[x] != part[y] and overlap(sets[x], sets[y], percent):
                        links.append((cids[x], cids[y]))
                        part[part == part[y]] = part[x]  # their other pairs need no look in this cell
            if links:
                yield pa.RecordBatch.from_pydict(dict(zip("ab", np.array(links).T)))

    return store(cells.mapInArrow(released(search), "a long, b long"), "family-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80,
                    size: int = SHINGLE) -> DataFrame:
    """Components of texts whose shingle sets satisfy ``100 * intersection >= percent * union``.

    Words are runs without ASCII white space, A-Z in lower case; a text of fewer words than
    ``size`` is one shingle. Returns one row per input row: the id, n_shingles (distinct, of the
    whole text), component_id (least id reachable by links, itself included) and kept (whether the
    id is that). Null texts and texts without words have no shingles and no links. Rows that share
    an id are one node and each gets a row; a row without an id has no links, a null component and
    is kept. Links are confirmed on full sets; a link at the threshold escapes all bands with
    probability below one in a million, whatever the threshold (``banding``).
    """
    bands, rows = banding(percent)
    count = bands * rows
    signed = store(sign(docs, id_col, text_col, size, count), "signatures")
    members = signed.select("id", "h", "g", "n")
    classes = signed.where("h is not null").groupBy("h", "g").agg(F.min("id").alias("id"), F.first("sig").alias("sig"))
    classes = store(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    shared = crowded(buckets(classes, bands, rows))
    texts = Texts(docs, classes, id_col, text_col)
    links = confirm(plausible(leader_pairs(shared), classes, percent, count), texts, percent, size)
    found = connected_components(links)
    joined = store(families(shared, classes, found, least_agreement(percent, count)), "joined")
    links = links.union(family_links(joined, found, texts, percent, size, count))
    named = name_rows(members, classes.select("h", "g", "cid", "id"), links, keep=("n",))
    return named.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")
