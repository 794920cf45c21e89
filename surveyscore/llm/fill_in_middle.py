"""Fill-in-middle: texts cut at line borders by a keyed hash, and put back together.

Cuts are named by rank ("after the k-th line") and needed as offsets. The borders of a batch of
texts form one rising sequence of byte offsets; ``RankIndex`` fits it with straight segments whose
error is bounded, and keeps what each border differs from its segment. A border is then found from
its rank: predicted by the segment, corrected exactly by the stored residual.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from surveyscore.llm.batches import pieces, released, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FORMS = np.array([PLAIN, PSM, SPM])
ERROR = 2_000  # bytes that a predicted border may be off, so that a residual fits 16 bits
SPAN = 4_096  # borders looked at together while a segment grows


class RankIndex:
    """Piecewise-linear index of a rising sequence: value by rank, exact.

    A segment starts at a border and takes as many further borders as some slope keeps within
    ``ERROR`` of the line: the cone of such slopes narrows with every border, and the segment ends
    where it closes. Stored are each segment's first rank, first value and slope, and a residual
    of two bytes for every rank.
    """

    def __init__(self, values: np.ndarray):
        first, slopes, at, n = [], [], 0, len(values)
        while at < n:
            low, high, stop = 0.0, np.inf, at + 1
            while stop < n:
                run = np.arange(stop, min(stop + SPAN, n))
                rise, gone = (values[run] - values[at]).astype(np.float64), run - at
                least = np.maximum(low, np.maximum.accumulate((rise - ERROR) / gone))
                most = np.minimum(high, np.minimum.accumulate((rise + ERROR) / gone))
                shut = np.flatnonzero(least > most)
                fits = int(shut[0]) if len(shut) else len(run)
                if fits:
                    low, high = least[fits - 1], most[fits - 1]
                stop += fits
                if len(shut):
                    break
            first.append(at)
            slopes.append(0.0 if np.isinf(high) else (low + high) / 2)
            at = stop
        self.first, self.slopes = np.array(first, dtype=np.int64), np.array(slopes)
        self.base = values[self.first] if n else values
        self.residuals = (values - self.predict(np.arange(n))).astype(np.int16)

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        if not len(ranks):
            return np.zeros(0, np.int64)
        segment = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[segment] + np.rint(self.slopes[segment] * (ranks - self.first[segment])).astype(np.int64)

    def find(self, ranks: np.ndarray) -> np.ndarray:
        return self.predict(ranks) + self.residuals[ranks]


def borders(raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of all borders of lines, each text's own beginning and end among them.

    Also each text's first place in this sequence, and one past its last.
    """
    after = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    within = after[~np.isin(after, at[1:])]  # the end of a text is a border anyway
    owner = np.searchsorted(at, within, "right") - 1
    filled = at[1:] > at[:-1]  # an empty text has one border, which is beginning and end
    count = np.bincount(owner, minlength=len(filled)) + 1 + filled
    stops = np.cumsum(count)
    out = np.empty(int(stops[-1]) if len(stops) else 0, np.int64)
    out[stops - count], out[stops - 1] = at[:-1], at[1:]
    rank = np.arange(len(within)) - np.searchsorted(within, at[:-1])[owner]
    out[(stops - count)[owner] + 1 + rank] = within
    return out, np.concatenate([[0], stops]).astype(np.int64)


def arranged(piece: pa.RecordBatch, fim_percent: int, spm_percent: int):
    """Columns n, form, prefix_chars, middle_chars, output of a batch of (id, text, h1..h4)."""
    raw, at = text_bytes(piece.column(1))
    values, ranks = borders(raw, at)
    index = RankIndex(values)
    units = np.diff(ranks) - 1
    h = [piece.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3, 4, 5)]
    cuts = np.sort(np.stack([h[0] % (units + 1), h[1] % (units + 1)]), axis=0)
    one, two = (index.find(ranks[:-1] + c) for c in cuts)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    form = np.where(h[2] % 100 >= fim_percent, 0, np.where(h[3] % 100 < spm_percent, 2, 1))
    prefix, middle, output = [], [], []
    for k, (a, b, c, d) in enumerate(zip(at[:-1].tolist(), one.tolist(), two.tolist(), at[1:].tolist())):
        text = raw[a:d]
        if not text or p in text or s in text or m in text:
            form[k] = 0
        if form[k] == 0:
            prefix.append(None)
            middle.append(None)
            output.append(text)
            continue
        before, within, after = raw[a:b], raw[b:c], raw[c:d]
        prefix.append(len(before.decode()))
        middle.append(len(within.decode()))
        output.append(p + before + s + after + m + within if form[k] == 1 else s + after + p + before + m + within)
    return units, FORMS[form], prefix, middle, pa.array(output, pa.binary()).cast(pa.string())


def rearrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_percent: int = 100,
              spm_percent: int = 50, seed: int = 7) -> DataFrame:
    """Every whole text with its middle moved to the end, or plain.

    Returns one row per input row: the id, n (lines), form (plain, psm, spm), prefix_chars and
    middle_chars (code points; null if plain) and output. Cuts and form follow from the sha256 of
    ``seed:id``. ``fim_percent`` of texts are rearranged, ``spm_percent`` of these with the suffix
    first; texts that are empty or hold a marker stay plain.

    A null or empty text has no lines and gives an empty plain output; a null id is hashed as the
    word ``null``. Repeated rows give repeated results, an empty table an empty one. Nothing is
    shuffled; a text of any length is handled whole, in a batch of its neighbours.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    source = source.select("id", "text", *[
        F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)])
    schema = T.StructType([T.StructField(id_col, source.schema["id"].dataType)]
                          + T.StructType.fromDDL("n long, form string, prefix_chars long, middle_chars long, output string").fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                found = arranged(piece, fim_percent, spm_percent)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).cast(arrow.field(0).type)]
                    + [pa.array(v, type=f.type) if not isinstance(v, pa.Array) else v.cast(f.type)
                       for v, f in zip(found, list(arrow)[1:])], schema=arrow)

    return source.mapInArrow(released(run), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.

    A text with markers inside is plain, so in the other forms the first place of each marker is
    the one that was written, and the output alone tells the parts.
    """
    def part(after: str, before: str | None):
        rest = F.substring_index(output, after, -1) if before is None else F.substring_index(output, before, 1)
        return rest if before is None else F.substr(rest, F.locate(after, rest) + len(after))

    psm = F.concat(part(PREFIX, SUFFIX), part(MIDDLE, None), part(SUFFIX, MIDDLE))
    spm = F.concat(part(PREFIX, MIDDLE), part(MIDDLE, None), part(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
