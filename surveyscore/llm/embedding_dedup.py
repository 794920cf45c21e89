"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors are projected on many Gaussian lines. Lines are taken in rounds of independent groups:
each line of a group is cut at zero, the middle of its order, and rows that fall on the same sides
of all lines of the group share a cell. A cut parts two vectors with a probability given by
their angle alone, so the lines of a group and the number of groups (``plan_groups``) follow from the
cosine, the recall and the number of rows, whatever the data. Within a cell two vectors collide on a
line if one lies in the window centred on the other; the window and the least count of collisions
follow from the same figures (``calibrate``). Pairs that reach the count are verified by cosine.

A pair counts in the first group where its rows share a cell, so no link is counted twice. A cell
yields one row per vector (its new links, and the least vector it is connected to there), never its
pairs. A cell with more than ``BLOCK`` rows is compared in pairs of blocks, each a task's worth; tiles whose
rows all shared an earlier cell are passed over. Comparisons grow as the rows to the power of 1.2 to 1.3
where vectors spread over directions; vectors near each other are all compared, as their number of
links has to be counted.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyscore.llm.batches import pieces, released
from surveyscore.llm.components import drop, least_reached, name_rows
from surveyscore.llm.grouped import sorted_groups
from surveyscore.llm.store import store

COSINE = 0.9
LINES = 64
FIRST = 24  # lines compared for all pairs; the others only for pairs that may still pass
RECALL = 0.999  # of pairs exactly at the least cosine; nearer pairs meet and collide more often
IN_CELLS = 0.9  # share of the pairs lost that cells may lose, the rest may fail the count of collisions
COPY = 1024  # cost of sending a row to a cell, in comparisons
CUTS = 30  # most lines in a group
WIDTH = 2.0  # half-width of a window, in standard deviations of a pair at the least cosine
BLOCK = 4096  # rows of a block
LISTED = 100_000  # most cells beyond a block that are broadcast
TILE = 512  # rows compared at a time
STEPS = 16  # of projected values in the half-width of a window
SEED = 20_240


def binomial_at_least(n: int, p: float, k: int) -> float:
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1))


def calibrate(lines: int, width: float, recall: float) -> int:
    """Largest count that a pair at the least cosine reaches with probability ``recall``."""
    p = math.erf(width / math.sqrt(2))
    return max((k for k in range(lines + 1) if binomial_at_least(lines, p, k) >= recall), default=0)


def plan_groups(n: int, cosine: float, recall: float) -> tuple[int, int]:
    """Lines of a group and number of groups: the cheapest that lets pairs at the least cosine meet.

    Few rows make one cell, and all pairs meet.
    """
    together = 1 - math.acos(min(1.0, max(-1.0, cosine))) / math.pi
    best = 0, 1, COPY + n
    for g in range(1, CUTS + 1):
        p = together**g
        groups = 1 if p >= recall else math.ceil(math.log(1 - recall) / math.log(1 - p))
        cost = groups * (COPY + n / 2**g)
        if cost < best[2]:
            best = g, groups, cost
    return best[:2]


@lru_cache(maxsize=4)
def directions(seed: int, length: int, lines: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((length, lines))


def project(vectors: np.ndarray, lines: int) -> np.ndarray:
    """Projections of unit vectors on fixed Gaussian lines."""
    return (vectors @ directions(SEED, vectors.shape[1], lines)).astype(np.float32)


def cell_keys(vectors: np.ndarray, g: int, groups: int) -> np.ndarray:
    """The cell of each unit vector in each group: one bit per line, the side of its middle."""
    sides = (vectors @ directions(SEED + 1, vectors.shape[1], g * groups) > 0).reshape(len(vectors), groups, g)
    return (sides.astype(np.int64) << np.arange(g)).sum(axis=2).astype(np.int32)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def steps(lens: np.ndarray, half: float) -> np.ndarray:
    """Projections in steps of a sixteenth of the half-width, as bytes; one row per line.

    Clipping brings values together only beyond the range of 256 steps, some 14 units wide.
    """
    return np.clip(np.floor(lens * (STEPS / half)) + 128, 0, 255).astype(np.uint8).T.copy()


def colliding(a: np.ndarray, b: np.ndarray, first: int, least: int, least_first: int):
    """Index pairs of two tiles whose windows collide on at least ``least`` lines.

    Values within the half-width are at most ``STEPS + 1`` steps apart, so no collision is missed.
    """
    shape = a.shape[1], b.shape[1]
    count, apart, near = np.zeros(shape, np.uint8), np.empty(shape, np.uint8), np.empty(shape, bool)
    moved = a + np.uint8(STEPS + 1)
    for k in range(first):
        np.subtract(moved[k][:, None], b[k][None, :], out=apart)
        np.less_equal(apart, 2 * STEPS + 2, out=near)
        count += near.view(np.uint8)
    i, j = np.nonzero(count >= least_first)
    kept = []
    for at in range(0, len(i), 1 << 16):
        x, y = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
        more = (moved[first:, x] - b[first:, y] <= 2 * STEPS + 2).sum(axis=0)
        kept.append(count[x, y] + more >= least)
    kept = np.concatenate([np.zeros(0, bool), *kept])
    return i[kept], j[kept]


def spanning(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray):
    """A few links with the components of all: each node of a tile to the least it reaches."""
    up, left = rows.copy(), columns.copy()
    top = np.iinfo(np.int64).max
    while True:
        new_up = np.minimum(up, np.where(linked, left, top).min(axis=1))
        new_left = np.minimum(left, np.where(linked, new_up[:, None], top).min(axis=0))
        if (new_up == up).all() and (new_left == left).all():
            break
        up, left = new_up, new_left
    found = np.concatenate([np.stack([rows, up], 1), np.stack([columns, left], 1)])
    return found[found[:, 0] != found[:, 1]]


def verified(r: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray, vectors: np.ndarray, cosine: float) -> np.ndarray:
    """Which pairs (r[i], c[j]) reach the cosine, always by the same sum.

    Where a tile has many pairs, its product decides those that rounding cannot move across.
    """
    hit = np.zeros(len(i), bool)
    unsure = np.arange(len(i))
    if len(i) * 8 > len(r) * len(c):
        product = (vectors[r] @ vectors[c].T)[i, j]
        hit = product >= cosine
        unsure = np.flatnonzero(np.abs(product - cosine) < 1e-9)
    for at in range(0, len(unsure), 1 << 14):
        k = unsure[at:at + (1 << 14)]
        hit[k] = np.einsum("nd,nd->n", vectors[r[i[k]]], vectors[c[j[k]]]) >= cosine
    return hit


def met_before(earlier: np.ndarray, tiles: list[np.ndarray]) -> np.ndarray:
    """Per tile and earlier group, the cell that all its rows share, or -1."""
    low = np.stack([earlier[t].min(axis=0) for t in tiles])
    return np.where(low == np.stack([earlier[t].max(axis=0) for t in tiles]), low, -1)


def compare(vectors: np.ndarray, weights: np.ndarray, earlier: np.ndarray, split: int, same: bool, cosine: float,
            lines: int, lost: float) -> tuple[np.ndarray, np.ndarray]:
    """New links of the rows before ``split`` with those after it (or among themselves).

    ``earlier``: each row's cells in the groups before this one; pairs that share one are left out.
    ``lost``: the share of pairs at the least cosine that may miss the count of collisions.
    Returns the weight linked to each row and the least row that each is connected to.
    """
    first = min(FIRST, lines)
    least, least_first = calibrate(lines, WIDTH, 1 - lost), calibrate(first, WIDTH, 1 - lost / 4)
    half = WIDTH * math.sqrt(2 - 2 * cosine)
    lens = steps(project(vectors, lines), half)
    n, linked, links = len(vectors), np.zeros(len(vectors), np.int64), [np.zeros((0, 2), np.int64)]
    left = [np.arange(s, min(s + TILE, split)) for s in range(0, split, TILE)]
    right = left if same else [np.arange(s, min(s + TILE, n)) for s in range(split, n, TILE)]
    if not left or not right:
        return linked, np.arange(n)
    shared_left, shared_right = met_before(earlier, left), met_before(earlier, right)
    for x, r in enumerate(left):
        for y in range(x if same else 0, len(right)):
            c = right[y]
            if ((shared_left[x] == shared_right[y]) & (shared_left[x] >= 0)).any():
                continue
            i, j = colliding(lens[:, r], lens[:, c], first, least, least_first)
            if same and r[0] == c[0]:
                i, j = i[i < j], j[i < j]
            new = np.ones(len(i), bool)
            for k in range(earlier.shape[1]):
                new &= earlier[r[i], k] != earlier[c[j], k]
            i, j = i[new], j[new]
            found = verified(r, c, i, j, vectors, cosine)
            if not found.any():
                continue
            hit = np.zeros((len(r), len(c)), bool)
            hit[i[found], j[found]] = True
            np.add.at(linked, r, hit @ weights[c])
            np.add.at(linked, c, hit.T @ weights[r])
            links.append(spanning(hit, r, c))
    return linked, least_reached(n, np.concatenate(links))


def near_duplicates(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = COSINE, lines: int = LINES, recall: float = RECALL) -> DataFrame:
    """Links at or above ``cosine`` among all vectors, and their components.

    Returns one row per input row: the id, n_links (other rows linked directly), component_id (the
    least id reachable by links, itself included) and kept (whether the row's id is that). Equal
    vectors are compared once and counted as often as they occur. Null, empty and zero vectors and
    those with a null or non-finite component link with nothing, nor do vectors of different
    lengths; rows that share an id are one node. A row without an id takes part in no link, has a
    null component and is kept.
    """
    kind = "array<float>" if dict(embeddings.dtypes)[vector_col] == "array<float>" else "array<double>"
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).cast(kind).alias("v"))
    usable = F.expr("""id is not null and v is not null and size(v) > 0
        and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x != 0)""")
    keyed = rows.select("id", F.when(usable, F.xxhash64("v")).alias("h"), F.when(usable, F.xxhash64(F.lit(1), "v")).alias("g"),
                        F.when(usable, F.col("v")).alias("v"))
    members = store(keyed.select("id", "h", "g"), "vectors")
    classes = keyed.where("h is not null").groupBy("h", "g").agg(
        F.min("id").alias("id"), F.count("*").alias("weight"), F.first("v").alias("v"))
    classes = store(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    found, used = None, []
    for length, n in sorted(tuple(r) for r in classes.groupBy(F.size("v")).count().collect()):
        part = link_classes(classes.where(F.size("v") == length), n, cosine, lines, recall, used)
        found = part if found is None else found.union(part)
    if found is None:
        found = members.sparkSession.createDataFrame([], "cid long, links long, root long")
    found = store(found, "vector-links")
    drop(*used)
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    counted = store(classes.select("h", "g", "cid", "id", "weight").join(links, "cid", "left").select(
        "h", "g", "cid", "id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "vector-counts")
    named = name_rows(members, counted, found.select(F.col("cid").alias("a"), F.col("root").alias("b")), ("n_links",))
    return named.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        "component_id", "kept")


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows; neither lists nor elements are null."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def with_cells(classes: DataFrame, g: int, groups: int) -> DataFrame:
    """Stored (cid, weight, v, cells): each vector with its cell in every group."""
    source = classes.select("cid", "weight", "v")
    schema = T.StructType([*source.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 1024):
                keys = cell_keys(unit(matrix(piece.column(2))), g, groups)
                starts = pa.array(np.arange(0, keys.size + 1, groups, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.ListArray.from_arrays(starts, pa.array(keys.ravel()))],
                                                 names=["cid", "weight", "v", "cells"])

    return store(source.mapInArrow(released(run), schema), "vector-cells")


def dealt(placed: DataFrame, used: list[DataFrame]) -> DataFrame:
    """Rows once for every group of lines and every pair of blocks that they belong to.

    A cell of at most ``BLOCK`` rows is one block. Larger ones are counted first; their rows are
    dealt over blocks by id. Stored tables that the result reads are added to ``used``.
    """
    met = placed.select("cid", "weight", "v", "cells", F.posexplode("cells").alias("turn", "cell"))
    large = store(placed.select(F.posexplode("cells").alias("turn", "cell")).groupBy("turn", "cell").agg(F.count("*").alias("rows"))
                  .where(F.col("rows") > BLOCK), "vector-large-cells")
    used += [placed, large]
    n = large.count()
    if n:
        met = met.join(F.broadcast(large) if n <= LISTED else large, ["turn", "cell"], "left")
    else:
        met = met.withColumn("rows", F.lit(None).cast("long"))
    parts = F.ceil(F.coalesce(F.col("rows"), F.lit(1)) / F.lit(BLOCK)).cast("int")
    met = met.withColumn("own", F.pmod(F.xxhash64("cid"), parts).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return met.select("turn", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid",
                      "weight", F.slice("cells", F.lit(1), F.col("turn")).alias("earlier"), "v")


def link_classes(classes: DataFrame, n: int, cosine: float, lines: int, recall: float, used: list[DataFrame]) -> DataFrame:
    """Links of distinct vectors of one length: (cid, links, root) for each row and pair of blocks."""
    g, groups = plan_groups(n, cosine, 1 - (1 - recall) * IN_CELLS)
    lost = (1 - recall) * (1 - IN_CELLS)

    def run(batches):
        for group in sorted_groups(batches, 4):
            if group.num_rows < 2:
                continue
            i, j = group.column(2)[0].as_py(), group.column(3)[0].as_py()
            own, cid, weights = (group.column(k).to_numpy() for k in (4, 5, 6))
            earlier = matrix(group.column(7)) if group.column(0)[0].as_py() else np.zeros((group.num_rows, 0), np.int32)
            near = [earlier[:, k] for k in range(min(2, earlier.shape[1]))][::-1]  # rows that met before next to each other
            order = np.lexsort([cid, *near, own])
            own, cid, weights, earlier = own[order], cid[order], weights[order], earlier[order]
            vectors = unit(matrix(group.column(8))[order])
            linked, root = compare(vectors, weights, earlier, int((own == i).sum()), i == j, cosine, lines, lost)
            at = np.flatnonzero(linked)
            yield pa.RecordBatch.from_arrays([pa.array(cid[at]), pa.array(linked[at]), pa.array(cid[root[at]])],
                                             names=["cid", "links", "root"])

    cells = dealt(with_cells(classes, g, groups), used)
    keys = ["turn", "cell", "i", "j"]
    width = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = cells.repartition(max(width, math.ceil(n * groups / 65536)), *keys).sortWithinPartitions(*keys)
    return spread.mapInArrow(released(run), "cid long, links long, root long")
