"""Secret scans: patterns for what names itself, and a battery of randomness tests for the rest.

A run of characters that may encode random bytes is tested against the alphabet it seems to be
written in: chi-squared uniformity of its characters, runs above and below the alphabet's middle,
and serial correlation of neighbours. Words, counters and paths fail; keys do not. The three
p-values are combined (Fisher), and a Benjamini-Hochberg step with weights by length controls how
many truly random runs of a document are taken for structured ones. What is not rejected, and
carries enough bits to be a secret, is reported.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from surveyscore.llm.batches import map_texts, pieces, released

# The base kinds in their order, with pattern, group that is measured, least length.
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.ASCII | re.IGNORECASE), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
ADDED = "random"
KINDS = [*BASE, ADDED]
RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
FALSE_RATE = 0.05  # of random runs among those rejected as structured
LEAST_BITS = 90  # of a run, at its alphabet's rate
LEAST_P = 0.001  # a run at or below it is structured whatever the others are
# Encodings by what a run must hold and may hold only; the first that fits is taken.
ENCODINGS = [
    ("hex", "0123456789abcdef", (r"[0-9]", r"[a-f]")),
    ("HEX", "0123456789ABCDEF", (r"[0-9]", r"[A-F]")),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", (r"[2-7]", r"[A-Z]")),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz", (r"[0-9]", r"[a-z]")),
    ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", (r"[0-9]", r"[A-Z]")),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", (r"[0-9]", r"[A-Z]", r"[a-z]")),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", (r"[0-9]", r"[A-Z]", r"[a-z]")),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", (r"[0-9]", r"[A-Z]", r"[a-z]")),
]
_TABLES = [(name, {c: i for i, c in enumerate(letters)}, [re.compile(p) for p in must])
           for name, letters, must in ENCODINGS]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each base kind; failing ones are dropped."""
    out = []
    for kind, (pattern, group, least) in BASE.items():
        if kind == "hex":  # the length test inside the pattern gives the same matches, sooner
            out += [(kind, *m.span()) for m in LONG_HEX.finditer(text)]
            continue
        out += [(kind, *m.span()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return out


def infer(run: str):
    """Index values in, and size of, the first alphabet that fits; None without one."""
    for _, table, must in _TABLES:
        if all(map(table.__contains__, run)) and all(p.search(run) for p in must):
            return np.array([table[c] for c in run]), len(table)
    return None


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def p_uniform(values: np.ndarray, size: int) -> float:
    """Chi-squared uniformity, by the statistic's exact mean and variance at this length."""
    n = len(values)
    counts = np.bincount(values, minlength=size)
    statistic = float((counts.astype(float) ** 2).sum() * size / n - n)
    return upper_tail((statistic - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))


def p_runs(values: np.ndarray, size: int) -> float:
    """Runs above and below the middle of the alphabet, two-sided."""
    high = values >= size / 2
    n, a = len(values), int(high.sum())
    b = n - a
    if not a or not b:
        return 2.0 ** (1 - n)
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 2 * a * b / n + 1
    variance = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    return 2 * upper_tail(abs(runs - mean) / math.sqrt(variance))


def p_serial(values: np.ndarray) -> float:
    """Correlation of neighbours, two-sided."""
    x = values - values.mean()
    power = float((x * x).sum())
    if power == 0:
        return 0.0
    r = float((x[1:] * x[:-1]).sum()) / power
    n = len(values)
    return 2 * upper_tail(abs(r + 1 / n) * math.sqrt(n))


def fisher(ps) -> float:
    """Combined p-value; for k tests the tail of chi-squared with 2k degrees in closed form."""
    half = -sum(math.log(max(p, 1e-300)) for p in ps)
    term = total = 1.0
    for i in range(1, len(ps)):
        term *= half / i
        total += term
    return math.exp(-half) * total


def structured(ps: list[float], lengths: list[int], rate: float = FALSE_RATE) -> list[bool]:
    """Which runs are rejected as random: weighted Benjamini-Hochberg, weights by length.

    A longer run carries more evidence and spends more of the error rate.
    """
    if not ps:
        return []
    mean = sum(lengths) / len(lengths)
    scaled = [min(1.0, p * mean / n) for p, n in zip(ps, lengths)]
    order = sorted(range(len(ps)), key=lambda i: scaled[i])
    passed = max((k for k, i in enumerate(order, 1) if scaled[i] <= rate * k / len(ps)), default=0)
    out = [p <= LEAST_P for p in ps]
    for i in order[:passed]:
        out[i] = True
    return out


def random_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Runs outside the base spans that the battery holds for random."""
    found = []
    for m in RUN.finditer(text):
        run = m.group().rstrip("=")
        if any(a < m.end() and m.start() < b for _, a, b in taken):
            continue
        fit = infer(run)
        if fit is None or len(run) * math.log2(fit[1]) < LEAST_BITS:
            continue
        values, size = fit
        found.append((m.span(), len(run), fisher([p_uniform(values, size), p_runs(values, size), p_serial(values)])))
    out = structured([p for _, _, p in found], [n for _, n, _ in found])
    return [(ADDED, *span) for (span, _, _), drop in zip(found, out) if not drop]


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind in the order of ``KINDS``; code points, end exclusive."""
    base = base_spans(text)
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(base + random_spans(text, base), key=lambda s: (s[1], order[s[0]], s[2]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets in every whole text.

    Returns one row per input row: the id and spans, an array of (kind, start, end) in code
    points, end exclusive, by start and kind: assign, access and hex from the patterns, random
    from the test battery. A null or empty text has none. Null ids, repeated rows and an empty
    table pass through.
    """

    def prepare():
        def work(texts):
            return [[[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] for t in texts]]

        return work

    return map_texts(docs, id_col, text_col, "spans array<struct<kind:string,start:int,end:int>>", prepare)


def redact(docs: DataFrame, text_col: str = "text", mask: str = "<secret>") -> DataFrame:
    """The same rows and columns, with every secret of ``text_col`` replaced by ``mask``.

    Spans that touch or overlap give one mask. A null text stays null.
    """
    def cover(text: str) -> str:
        parts, at = [], 0
        for a, b in merged([(s, e) for _, s, e in find_spans(text)]):
            parts += [text[at:a], mask]
            at = b
        return "".join([*parts, text[at:]])

    at = docs.columns.index(text_col)
    fields = [T.StructField(f.name, T.StringType() if k == at else f.dataType) for k, f in enumerate(docs.schema.fields)]
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                texts = [t if t is None else cover(t) for t in piece.column(at).to_pylist()]
                arrays = [pa.array(texts, f.type) if k == at else c.cast(f.type)
                          for k, (c, f) in enumerate(zip(piece.columns, arrow))]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(released(run), schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
