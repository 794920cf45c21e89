"""Token counts by a two-tier lookup on the map side.

A pre-token has the same tokens wherever it stands. Texts are split into the tokenizer's own
pre-tokens where all their characters are Latin-1, for which the split is written out below, and
else into blank-free runs, which the library splits further. Tier one is a broadcast hash table with the lengths of the most
frequent pre-tokens; tier two is a bounded cache in each Python worker, filled by encoding what the
table lacks. No pre-token is ever shuffled: the table comes from heavy-hitter summaries of fixed
size, one per task, merged as a tree. The table and the cache only save work: every length comes
from the library.
"""

from __future__ import annotations

import json
import os
import pickle
import re
import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyscore.llm.batches import map_texts, once_per_worker, pieces, released, text_list

FREQUENT = 65_536  # entries of the broadcast table
LONGEST = 64  # characters of a pre-token that is kept in the table or a cache
CACHED = 120_000  # entries of a worker's cache; a full cache starts anew
# Blanks at which every pre-token ends. Other white space stays inside and is left to the library.
BLANKS = re.compile(r"[ \t\n\r]+")
# The split pattern for which PRETOKENS stands, and the classes of Latin-1 characters.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTER, _NUMBER, _WHITE = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
PRETOKENS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTER}]+|[{_NUMBER}]|[^{_WHITE}{_LETTER}{_NUMBER}]+").findall
NORMALIZERS = ["NFC", "Replace", "Lowercase"]


class Splitter:
    """Pre-tokens of a text for one tokenizer file; joined by blanks they have the text's tokens."""

    def __init__(self, text: str):
        spec = json.loads(text)
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.known = ([s["type"] for s in steps] == NORMALIZERS
                      and first.get("pattern") == {"Regex": SPLIT} and first.get("invert") is True)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def __call__(self, text: str) -> list[str]:
        if not self.known:
            return [w for w in BLANKS.split(text) if w]
        if self.plain(text):
            return PRETOKENS(text.lower())
        runs = [w for w in BLANKS.split(text) if w]
        plain = [self.plain(w) for w in runs]
        whole = [w for w, p in zip(runs, plain) if not p]
        return PRETOKENS(" ".join(w for w, p in zip(runs, plain) if p).lower()) + whole

    def plain(self, text: str) -> bool:
        """Only Latin-1 characters and no added token."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(t in text for t in self.special)


def tokenizer_json(path: str) -> str:
    """Text of a tokenizer file, read by the driver: a vocabulary of fixed size."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def load_tokenizer(text: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def lengths(tokenizer, words: list[str]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def keep_heavy(counts: Counter, size: int) -> Counter:
    """Cut a summary to ``size`` entries: subtract the next count from all (Misra and Gries).

    A pre-token whose share of all counted is above 1 / size is never lost.
    """
    if len(counts) <= size:
        return counts
    cut = sorted(counts.values(), reverse=True)[size]
    return Counter({w: n - cut for w, n in counts.items() if n > cut})


def frequent_pretokens(docs: DataFrame, text_col: str, spec: str, size: int = FREQUENT) -> list[str]:
    """The heavy pre-tokens of all texts, at most ``size``, none above ``LONGEST`` characters."""

    def summarise(batches):
        counts, split = Counter(), Splitter(spec)
        for batch in batches:
            for piece in pieces(batch):
                for text in text_list(piece.column(0)):
                    counts.update(split(text))
                if len(counts) > 6 * size:
                    counts = keep_heavy(counts, 2 * size)
        counts = Counter({w: n for w, n in counts.items() if 0 < len(w) <= LONGEST})
        yield pa.RecordBatch.from_pydict({"summary": [pickle.dumps(keep_heavy(counts, size))]})

    def merge(a: Counter, b: Counter) -> Counter:
        return keep_heavy(a + b, size)

    summaries = docs.select(F.col(text_col).cast("string")).mapInArrow(released(summarise), "summary binary")
    merged = summaries.rdd.map(lambda r: pickle.loads(r[0]))
    return sorted(merged.treeReduce(merge, depth=3)) if merged.getNumPartitions() else []


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, frequent: int = FREQUENT) -> DataFrame:
    """Tokens of every whole text, as the ``tokenizers`` library counts them.

    ``tokenizer``: path of a ``.json`` file whose pre-tokenizer drops white space and whose
    normalizer does not join what blanks separate (file of fixed size, read by the driver). Returns one row per input row: the id, n_bytes
    (UTF-8) and n_tokens (no added tokens; special strings inside texts count as the library's
    default has it), over_limit (n_tokens > limit). A null text counts as empty: 0 bytes, 0
    tokens. Null ids, repeated rows and an empty table pass through.
    """
    spark = docs.sparkSession
    text = tokenizer_json(tokenizer)
    own = load_tokenizer(text)
    words = frequent_pretokens(docs, text_col, text, frequent)
    shared = spark.sparkContext.broadcast((text, dict(zip(words, lengths(own, words)))))

    key = uuid.uuid4().hex

    def prepare():
        spec, table = shared.value
        encoder, cache = once_per_worker(key, lambda: (load_tokenizer(spec), {}))
        split, known = Splitter(spec), table.get

        def work(texts: list[str]):
            rare, totals = [], []
            for t in texts:
                words = split(t)
                totals.append(sum(filter(None, map(known, words))))
                rare.append([w for w in words if w not in table])
            new = {w for ws in rare for w in ws if w not in cache}
            if len(cache) + len(new) > CACHED:
                cache.clear()
                new = {w for ws in rare for w in ws}
            brief = [w for w in new if len(w) <= LONGEST]
            cache.update(zip(brief, lengths(encoder, brief)))
            long = [w for w in new if len(w) > LONGEST]
            once = dict(zip(long, lengths(encoder, long)))
            for i, ws in enumerate(rare):
                totals[i] += sum(cache[w] if w in cache else once[w] for w in ws)
            return [len(t.encode()) for t in texts], totals, [n > limit for n in totals]

        return work

    return map_texts(docs, id_col, text_col, "n_bytes long, n_tokens long, over_limit boolean", prepare)
