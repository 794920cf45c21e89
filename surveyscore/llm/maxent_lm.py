"""A hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history). The most frequent training words
fill classes of equal size, in order of frequency; all other words, seen or not, fall into classes
by their ending. Within an ending class the other words of the broadcast table are leaves of a tree
of three levels, as is one leaf for all words beyond the table; its fan-out follows from the counts.
Every factor is a softmax over the sum of hashed features of the history: the last word, the last
two, and the one before the last (a skip). In a history each word of the table is itself, and any
other word a hash of itself. Beyond the table a word has its smoothed share of its leaf's training
tokens, with one share for what was never seen, so that probabilities sum to one at most. Feature
tables grow with the training tokens between two bounds.

Training is one pass over all training tokens in a fixed number of rounds; in each, every task
takes Adagrad steps through its own rows and the moves are mixed (``mixing``). Scores are computed
in numpy batches over the feature rows that a batch touches. Tables are raised to powers once a task:
a history's powers are then products of table rows, and a step multiplies rows, so that no power is
taken for a token.

Word counts are exact and cover the whole corpus. Tokens of words frequent enough for a bounded
broadcast table are looked up in the task; the rest, none of them frequent, are joined by word.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from surveyscore.llm.batches import once_per_worker, pieces, released
from surveyscore.llm.mixing import Tables, mix
from surveyscore.llm.store import store

END = b""  # closes every text; no word is empty
FREQUENT = 131_072  # most words of the broadcast table
LONGEST = 64  # bytes of a word in it
CLASSES, SIZE = 16, 64  # classes of frequent words, words of each
ENDINGS = 16  # classes of other words, by their last three bytes
MODEL_WORDS = CLASSES * SIZE
NOTHING = MODEL_WORDS + ENDINGS  # what stands before a text
TABLE, RARE = 1 << 30, 1 << 31  # marks of codes: other words of the broadcast table, and words beyond it
LEAF, HASH = 18, 27  # bits of a leaf's place in its ending, and of a rare word's hash
ROW_BITS = 14, 16  # of a feature table's rows: least and most
TOKENS_A_ROW = 1024  # training tokens for each row between these bounds
FEATURES = 3
ROUNDS = 2
TOGETHER = 3  # partitions that one task learns from
STEP = 4096  # tokens of a gradient step
WINDOW = 16 * STEP  # tokens whose feature rows are found at once
SCORED = 16384  # tokens of a scored batch
RATE = 0.1
HALF = np.float32(0.5**0.5)
HIGHEST = 25.0  # bound of a weight whose power is taken, far beyond what training reaches
FEW = 6  # steps of a table row, up to which they are added one after the other
FLUSH = 1 << 25  # bytes of words that a task counts before it hands them on
CODED = 1 << 22  # bytes of texts that are looked up at once


def tokens_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, then one end."""
    words = text.encode().lower().split()
    words.append(END)
    return words


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of ``tokens_of`` without ends, of all texts in a row, and how many each text has; null is empty."""
    texts = pc.ascii_trim_whitespace(texts.fill_null(""))
    full = pc.greater(pc.binary_length(texts), 0)  # an empty text would be split into one empty word
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.filter(full)))
    sizes = np.zeros(len(texts), np.int64)
    sizes[full.to_numpy(zero_copy_only=False)] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return lists.flatten(), sizes


def endings(words: list[bytes]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w[-3:]) for w in words), np.int64, len(words)) % ENDINGS


def ending(word: bytes) -> int:
    return int(endings([word])[0])


def rare_codes(words: list[bytes], ends: np.ndarray) -> np.ndarray:
    hashes = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    return (RARE | ends << HASH | hashes & ((1 << HASH) - 1)).astype(np.uint32)


def rare_code(word: bytes) -> int:
    return int(rare_codes([word], endings([word]))[0])


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over the column text; each task sums its own counts first."""

    def run(batches):
        held, size, ends = [], 0, 0
        for batch in batches:
            for piece in pieces(batch):
                words, sizes = words_of(piece.column(0))
                held.append(words)
                size += words.nbytes
                ends += len(sizes)
                if size >= FLUSH:
                    yield rows(*pc.value_counts(pa.chunked_array(held)).flatten())
                    held, size = [], 0
        if ends:
            if held:
                yield rows(*pc.value_counts(pa.chunked_array(held)).flatten())
            yield rows(pa.array([END]), pa.array([ends]))

    def rows(words, counts):
        return pa.RecordBatch.from_arrays([words.cast(pa.binary()), counts.cast(pa.int64())], names=["word", "n"])

    return texts.select("text").mapInArrow(released(run), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Totals, the broadcast table of frequent words, and the ending classes' totals."""

    def __init__(self, counts: DataFrame):
        self.tokens, self.words = (int(x or 0) for x in counts.agg(F.sum("n"), F.count("*")).first())
        short = F.octet_length("word") <= LONGEST
        sizes = counts.where(short).groupBy("n").count().orderBy(F.desc("n"))
        self.least, room = None, FREQUENT  # least count of the table: of all counts, the table holds what fits
        for n, words in sizes.toLocalIterator():
            room -= words
            if room < 0:
                break
            self.least = n
        self.in_table = short & (F.col("n") >= (self.least if self.least is not None else 1 << 62))
        found = [(bytes(r[0]), r[1]) for r in counts.where(self.in_table).toLocalIterator()]
        found.sort(key=lambda x: (-x[1], x[0]))
        self.frequent = [w for w, _ in found]
        self.counts = np.array([n for _, n in found], np.int64)
        self.model_counts = np.array([n for _, n in found[:MODEL_WORDS]], float)
        ends = endings(self.frequent[MODEL_WORDS:])
        leaf = np.zeros(len(ends), np.int64)
        for e in range(ENDINGS):
            leaf[ends == e] = 1 + np.arange((ends == e).sum())  # leaf 0 is for all words beyond the table
        top = np.arange(min(len(found), MODEL_WORDS))
        self.codes = np.concatenate([top, TABLE | ends << LEAF | leaf]).astype(np.uint32)

        ending_of = F.crc32(F.substring("word", -3, 3)) % ENDINGS
        totals = counts.groupBy(ending_of.alias("e")).agg(F.sum("n"), F.count("*")).collect()
        seen, kinds = np.zeros(ENDINGS), np.zeros(ENDINGS)
        for e, n, v in totals:
            seen[e], kinds[e] = n, v
        for w, n in found[:MODEL_WORDS]:
            seen[ending(w)] -= n
            kinds[ending(w)] -= 1
        self.ending_tokens, self.ending_shares = seen, seen + 0.1 * (kinds + 1)
        listed = self.counts[MODEL_WORDS:] + 0.1
        self.beyond_shares = np.maximum(self.ending_shares - np.bincount(ends, listed, ENDINGS), 0.1)
        self.fan = 2
        while self.fan ** 3 < leaf.max(initial=0) + 1:
            self.fan += 2
        self.leaves = np.zeros((ENDINGS, self.fan ** 3))
        self.leaves[ends, leaf] = listed
        self.leaves[:, 0] = self.beyond_shares

    def weights(self) -> Tables:
        """Tables before training: the frequencies of classes, and of words within them."""
        words = np.concatenate([self.model_counts, np.zeros(MODEL_WORDS - len(self.model_counts))]).reshape(CLASSES, SIZE)
        masses = np.concatenate([words.sum(1), self.ending_tokens]) + 0.1
        real = np.arange(MODEL_WORDS).reshape(CLASSES, SIZE) < len(self.model_counts)
        low, high = ROW_BITS
        rows = 1 << min(max((self.tokens // TOKENS_A_ROW).bit_length(), low), high)
        three = self.leaves.reshape(-1, self.fan)
        two = three.sum(1).reshape(-1, self.fan)
        nodes = np.concatenate([two.sum(1).reshape(-1, self.fan), two, three])
        with np.errstate(divide="ignore"):
            return {"class_base": np.log(masses / masses.sum()).astype(np.float32)[None, :],
                    "word_base": np.where(real, np.log((words + 0.1) / (words.sum(1, keepdims=True) + 0.1)), -30).astype(np.float32),
                    "tree_base": np.where(nodes > 0, np.log(nodes / np.maximum(nodes.sum(1, keepdims=True), 0.1)), -30).astype(np.float32),
                    "class": np.zeros((rows, CLASSES + ENDINGS), np.float32),
                    "word": np.zeros((rows, SIZE), np.float32),
                    "tree": np.zeros((rows, self.fan), np.float32)}


def encode(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Each row's tokens as codes, its sums over words of the broadcast table, and its other words."""
    packed = b"\n".join(vocabulary.frequent) if vocabulary.frequent else None  # words hold no white space
    shared = texts.sparkSession.sparkContext.broadcast(
        (packed, vocabulary.counts, vocabulary.tokens + 0.1 * (vocabulary.words + 1), vocabulary.codes))
    key = uuid.uuid4().hex
    source = texts.select("row", "id", "held", "text")
    own = "n_tokens long, ids binary, base double, known long, rest array<struct<word:binary,n:int,ending:int>>"
    schema = T.StructType([*source.schema.fields[:3], *T.StructType.fromDDL(own).fields])
    arrow = to_arrow_schema(schema)

    def prepare():
        packed, counts, total, codes = shared.value
        words = [] if packed is None else packed.split(b"\n")
        return pa.array(words, pa.binary()), words.index(END) if END in words else None, codes, np.log10((counts + 0.1) / total)

    def run(batches):
        listed, end, codes, base = once_per_worker(key, prepare)
        for batch in batches:
            for piece in pieces(batch, max(1, CODED * batch.num_rows // max(batch.nbytes, CODED))):
                passed = [c.cast(f.type) for c, f in zip(piece.columns[:3], arrow)]
                made = coded(*words_of(piece.column(3)), listed, end, codes, base)
                yield pa.RecordBatch.from_arrays([*passed, *(c.cast(f.type) for c, f in zip(made, list(arrow)[3:]))], schema=arrow)

    def coded(words, sizes, listed, end, codes, base):
        words = words.cast(pa.binary())
        at = pc.index_in(words, value_set=listed)
        beyond = words.filter(at.is_null()).dictionary_encode()
        kinds = pa.concat_arrays([beyond.dictionary, pa.array([END], pa.binary())])  # distinct words beyond the table, and an end
        others = kinds.to_numpy(zero_copy_only=False).tolist()
        ends = endings(others)
        at = at.fill_null(-1).to_numpy(zero_copy_only=False).copy()
        at[at < 0] = len(listed) + beyond.indices.to_numpy(zero_copy_only=False)
        stops = np.cumsum(sizes + 1)
        starts = stops - sizes - 1
        tokens = np.full(stops[-1], len(listed) + len(others) - 1 if end is None else end, np.int64)
        inside = np.ones(len(tokens), bool)
        inside[stops - 1] = False
        tokens[inside] = at
        ids = np.concatenate([codes, rare_codes(others, ends)]).take(tokens)
        ids = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(np.append(0, 4 * stops)), pa.py_buffer(ids)])
        sums = np.add.reduceat(np.append(base, np.zeros(len(others))).take(tokens), starts)
        where = np.flatnonzero(tokens >= len(listed))
        pairs = np.searchsorted(stops, where, side="right") * len(others) + tokens.take(where) - len(listed)
        pairs, times = np.unique(pairs, return_counts=True)
        kind = pairs % len(others)
        offsets = np.searchsorted(pairs, np.arange(len(sizes) + 1) * len(others))
        known = sizes + 1 - np.diff(np.append(0, np.cumsum(times))[offsets])
        rest = pa.StructArray.from_arrays([kinds.take(pa.array(kind)), pa.array(times.astype(np.int32)), pa.array(ends[kind].astype(np.int32))],
                                          names=["word", "n", "ending"])
        return pa.array(sizes + 1), ids, pa.array(sums), pa.array(known), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), rest)

    return source.mapInArrow(released(run), schema)


def features_of(codes: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """32-bit hashes of each token's history; ``starts`` are the first tokens of texts."""
    one = np.empty(len(codes), np.uint64)
    one[1:] = codes[:-1]
    one[starts] = NOTHING
    two = np.empty(len(codes), np.uint64)
    two[1:] = one[:-1]
    two[starts] = NOTHING
    return [hashed(1, one), hashed(2, one + two * np.uint64(0xC2B2AE3D27D4EB4F)), hashed(3, two)]


def hashed(kind: int, key: np.ndarray) -> np.ndarray:
    mixed = (key + np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(32)).astype(np.uint32)


def rows_of(table: np.ndarray, features, nodes: np.ndarray | None = None) -> list[np.ndarray]:
    """Rows of a weight table: the features' own, or those of features joined with a class or node."""
    shift = np.uint32(33 - len(table).bit_length())
    if nodes is not None:
        own = nodes.astype(np.uint32) * np.uint32(0x9E3779B1) + np.uint32(0x7F4A7C15)
        features = [(f ^ own) * np.uint32(0x85EBCA77) for f in features]
    return [(f >> shift).astype(np.uint16) for f in features]


def parts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each code, its ending where it has one, and its leaf there (-1 without a leaf)."""
    rare = codes >= RARE
    ends = np.where(rare, codes >> HASH, np.where(codes >= TABLE, codes >> LEAF, codes - MODEL_WORDS)) & (ENDINGS - 1)
    classes = np.where(codes < MODEL_WORDS, codes // SIZE, CLASSES + ends)
    return classes, ends, np.where(rare, 0, np.where(codes >= TABLE, codes & ((1 << LEAF) - 1), -1))


def path(ends: np.ndarray, leaves: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes from the endings to the leaves and the branch taken at each, three for one token after the other."""
    two = leaves // fan
    one = two // fan
    first = ends * fan + one
    second = first * fan + two - one * fan
    nodes = np.stack([ends, ENDINGS + first, ENDINGS * (1 + fan) + second], axis=1)
    return nodes.ravel(), np.stack([one, two - one * fan, leaves - two * fan], axis=1).ravel()


def factors(tables: Tables, ids: np.ndarray, features):
    """For each table the tokens that it predicts, in order, with feature rows, rows of its base, and outcomes."""
    classes, ends, leaves = parts(ids)
    yield "class", np.arange(len(ids)), rows_of(tables["class"], features), np.zeros(len(ids), np.int64), classes
    known = np.flatnonzero(ids < MODEL_WORDS)
    own = classes[known]
    yield "word", known, rows_of(tables["word"], [f[known] for f in features], own), own, ids[known] % SIZE
    deep = np.flatnonzero(leaves >= 0)
    nodes, branches = path(ends[deep], leaves[deep], tables["tree"].shape[1])
    deep = np.repeat(deep, 3)
    yield "tree", deep, rows_of(tables["tree"], [f[deep] for f in features], nodes), nodes, branches


def powers_of(logits: np.ndarray) -> np.ndarray:
    np.clip(logits, -80, 80, out=logits)  # far beyond what weights reach; exp stays finite
    return np.exp(logits, out=logits)


def totals_of(powers: np.ndarray) -> np.ndarray:
    return powers @ np.ones(powers.shape[1], powers.dtype)


def shares_of(powers: np.ndarray) -> np.ndarray:
    powers *= (1 / totals_of(powers))[:, None]
    return powers


def softmax(logits: np.ndarray) -> np.ndarray:
    return shares_of(powers_of(logits))


def logits_of(table: np.ndarray, base: np.ndarray, features) -> np.ndarray:
    out = table.take(features[0], axis=0)
    for f in features[1:]:
        out += table.take(f, axis=0)
    out += base
    return out


def products_of(powers: np.ndarray, features) -> np.ndarray:
    """The powers of ``logits_of`` without a base, from the powers of the table."""
    out = powers.take(features[0], axis=0)
    for f in features[1:]:
        out *= powers.take(f, axis=0)
    return out


def raised(weights: Tables) -> Tables:
    """The powers of all tables. Three rows at a bound and a base, multiplied, stay finite and above zero."""
    return {k: np.exp(v if k.endswith("base") else np.clip(v, -HIGHEST, HIGHEST)) for k, v in weights.items()}


def whole_rows(table: np.ndarray) -> np.ndarray:
    """The rows of a table as single items, which numpy copies at once."""
    return table.view(np.dtype((np.void, table.shape[1] * table.itemsize))).ravel()


def slopes_by_row(features, slopes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows that features touch, and the sum of slopes of each."""
    at, tokens = np.concatenate(features), np.tile(np.arange(len(slopes)), len(features))
    order = np.argsort(at, kind="stable")
    rows, tokens = at.take(order), tokens.take(order)
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    times = np.diff(first, append=len(rows))
    often = np.flatnonzero(times > 1)
    often = often.take(np.argsort(times.take(often).astype(np.uint16), kind="stable")[::-1])  # longest runs first, then rows touched once
    by = np.concatenate([often, np.flatnonzero(times == 1)])
    first, times = first.take(by), times.take(often)
    more = np.searchsorted(-times, -np.arange(FEW + 1))  # rows that are touched more than k times
    long = more[FEW]
    out = np.empty((len(first), slopes.shape[1]), np.float32)
    slopes.take(tokens.take(first[long:]), axis=0, out=out[long:], mode="clip")
    for k in range(1, FEW):
        out[long:more[k]] += slopes.take(tokens.take(first[long:more[k]] + k), axis=0)
    if long:
        times = times[:long]
        starts = np.cumsum(times) - times
        own = tokens.take(np.arange(times.sum()) + np.repeat(first[:long] - starts, times))
        pairs = slopes.take(own, axis=0).view(np.complex64)  # two columns are added at a time
        np.add.reduceat(pairs, starts, out=out[:long].view(np.complex64))
    return rows.take(first).astype(np.int64), out


def descend(powers: np.ndarray, seen: np.ndarray, features, slopes: np.ndarray) -> None:
    """Adagrad on the rows that features touch, one rate per row; ``powers`` is a table raised to powers.

    ``seen`` has a row's sum of squares as real part and its number of steps as imaginary part. A
    weight's step s multiplies its power by e^s, here 1 + s + s^2 / 2 = (s / 2^0.5 + 0.5^0.5)^2 + 0.5,
    which is above zero; the error is of third order in a step that one rate keeps small.
    """
    rows, g = slopes_by_row(features, slopes)
    now = seen.take(rows)
    now += np.einsum("nd,nd->n", g, g) / g.shape[1] + np.complex64(1j)
    seen[rows] = now
    g *= (-RATE * HALF / np.sqrt(now.real))[:, None]
    g += HALF
    g *= g
    g += np.float32(0.5)
    g *= powers.take(rows, axis=0)
    whole_rows(powers)[rows] = whole_rows(g)


def gathered(batches, column: int):
    """Tokens of many texts, some ``WINDOW`` at a time."""
    held, size = [], 0
    for batch in batches:
        for value in batch.column(column):
            held.append(np.frombuffer(value.as_buffer(), np.uint32))
            size += len(held[-1])
            if size >= WINDOW:
                yield held
                held, size = [], 0
    if held:
        yield held


def learn(weights: Tables, batches):
    own = raised(weights)
    seen = {k: np.ones(len(v), np.complex64) for k, v in own.items()}
    taught = 0
    for texts in gathered(batches, 0):
        ids = np.concatenate(texts).astype(np.int64)
        starts = np.cumsum([0, *map(len, texts[:-1])])
        features = features_of(ids, starts)
        for at in range(0, len(ids), WINDOW):
            teach(own, seen, ids[at:at + WINDOW], [f[at:at + WINDOW] for f in features])
        taught += len(ids)
    if not taught:
        return None
    return {k: np.log(own[k]) - weights[k] for k in own}, {k: v.imag for k, v in seen.items()}


def teach(own: Tables, seen: Tables, ids: np.ndarray, features) -> None:
    """Steps of ``STEP`` tokens, table by table: no table depends on another."""
    for name, tokens, rows, kinds, labels in factors(own, ids, features):
        borders = np.searchsorted(tokens, np.arange(0, len(ids) + STEP, STEP)).tolist()
        for a, b in zip(borders[:-1], borders[1:]):
            if a < b:
                step(own[name], own[name + "_base"], seen[name], [r[a:b] for r in rows], kinds[a:b], labels[a:b])


def step(powers: np.ndarray, base: np.ndarray, seen: np.ndarray, rows, kinds: np.ndarray, labels: np.ndarray) -> None:
    products = products_of(powers, rows)
    products *= base[0] if len(base) == 1 else base.take(kinds, axis=0)
    slopes = shares_of(products)
    slopes.ravel()[np.arange(0, slopes.size, slopes.shape[1]) + labels] -= 1
    descend(powers, seen, rows, slopes)


def log10_probability(weights: Tables, texts: list[np.ndarray]) -> np.ndarray:
    """Of each text's classes, frequent words and leaves, given their histories."""
    return log10_by_powers(raised(weights), texts)


def log10_by_powers(powers: Tables, texts: list[np.ndarray]) -> np.ndarray:
    def chance(name, rows, kinds, labels):
        products, base = products_of(powers[name], rows), powers[name + "_base"]
        width = products.shape[1]
        own = products.ravel().take(np.arange(0, products.size, width) + labels) * base.ravel().take(kinds * width + labels)
        totals = products @ base[0] if len(base) == 1 else np.einsum("nd,nd->n", products, base.take(kinds, axis=0))
        return own.astype(float) / totals

    sizes = np.array([len(t) for t in texts])
    ids = np.concatenate(texts).astype(np.int64)
    starts = np.cumsum([0, *sizes[:-1]])
    features = features_of(ids, starts)
    order = np.argsort((features[0] >> np.uint32(16)).astype(np.uint16), kind="stable")  # equal histories use the same rows
    ids, features = ids.take(order), [f.take(order) for f in features]
    out = np.empty(len(ids))
    for at in range(0, len(ids), SCORED):
        i, f = ids[at:at + SCORED], [x[at:at + SCORED] for x in features]
        p = np.ones(len(i))
        for name, tokens, rows, kinds, labels in factors(powers, i, f):
            own = chance(name, rows, kinds, labels)
            if name == "tree":
                tokens, own = tokens[::3], own[::3] * own[1::3] * own[2::3]
            p[tokens] *= own
        out[order[at:at + SCORED]] = np.log10(np.maximum(p, 1e-300))
    return np.add.reduceat(out, starts)


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows where ``held`` is false, and score all rows.

    Returns one row per input row: the id, held_out, n_tokens (words and one end), n_known (tokens
    that occur in training), train_tokens, base_score (log10 probability by smoothed word counts)
    and score (by the model). A null text is empty: its end alone. Repeated rows are counted and
    scored each; null ids pass through; a null ``held`` counts as false; an empty table gives an
    empty result, and without training rows every word is unseen.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(held, F.lit(False)).alias("held"),
                        F.col(text_col).cast("string").alias("text"))
    counts = store(count_words(texts.where("not held")), "lm-counts")
    vocabulary = Vocabulary(counts)
    encoded = store(encode(texts.withColumn("row", F.monotonically_increasing_id()), vocabulary), "lm-encoded")
    weights = vocabulary.weights()
    for k in range(ROUNDS):
        part = encoded.where(~F.col("held") & (F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == k))
        weights = mix(part.select("ids"), weights, learn, TOGETHER)
    beyond = rare_words(encoded, counts.where(~vocabulary.in_table), vocabulary)
    zero = F.lit(0)
    return scored(encoded, weights).join(beyond, "row", "left").select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("rest_known", zero)).cast("long").alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("rest_within", zero)).alias("score"))


def rare_words(encoded: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Sums over each row's words beyond the broadcast table."""
    listed = encoded.select("row", F.explode("rest").alias("r")).select("row", "r.word", F.col("r.n").alias("times"), "r.ending")
    share = F.element_at(F.array(*[F.lit(float(x)) for x in vocabulary.beyond_shares]), F.col("ending") + 1)
    n = F.coalesce("n", F.lit(0)) + 0.1
    total = vocabulary.tokens + 0.1 * (vocabulary.words + 1)
    return listed.join(counts.hint("shuffle_hash"), "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(n / total)).alias("rest_base"),
        F.sum(F.col("times") * F.log10(n / share)).alias("rest_within"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("rest_known"))


def scored(encoded: DataFrame, weights: Tables) -> DataFrame:
    shared = encoded.sparkSession.sparkContext.broadcast(weights)
    key = uuid.uuid4().hex
    source = encoded.select("row", "id", "held", "n_tokens", "known", "base", "ids")
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("model", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        powers = once_per_worker(key, lambda: raised(shared.value))
        for batch in batches:
            for piece in pieces(batch):
                texts = [np.frombuffer(v.as_buffer(), np.uint32) for v in piece.column(6)]
                columns = [c.cast(f.type) for c, f in zip(piece.columns[:6], arrow)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(log10_by_powers(powers, texts))], schema=arrow)

    return source.mapInArrow(released(run), schema)
