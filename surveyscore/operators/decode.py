"""Decode key presses to option labels.

Rules are data. An *arm* maps (book, position, ordering, digit) to a label; the lowest ``ord``
wins when several arms fit. Books whose ordering codes spell the options read out ("BIO" = first
B, then I, then the last letter) need no arms: a letter table and the first digit are enough.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyscore.functions import scalars as fn
from surveyscore.rules import broadcast_if_small, rule_table

UNSET_ORDERING = "SET_SEQ"  # fixed value: ordering of a vendor that no rule names
FORMS = ("both", "prefix", "exact")


@dataclass(frozen=True)
class Arm:
    position: int  # 1 = first key, 2 = any later key
    ordering: str
    digit: str
    label: str
    form: str = "both"  # "prefix" needs a further key, "exact" forbids one


@dataclass(frozen=True)
class Spelling:
    """Rule of a spelled book: the first option sits on key ``base``, the next one key up.

    The last letter (normally "others") sits on ``base + max(length - 1, 3)``, so a
    three-letter code leaves one key unused. After 9 comes 0.
    """

    base: int
    letters: Mapping[str, str]

    def arms(self, orderings: Iterable[str], keys: str | None = None, position: int = 1) -> list[Arm]:
        """Write the rule out as arms for a closed list of orderings.

        ``keys`` names the key of each letter where a question was laid out differently.
        """
        out = []
        for code in orderings:
            for i, letter in enumerate(code):
                step = i if i < len(code) - 1 else max(i, 3)
                digit = keys[i] if keys else str((self.base + step) % 10)
                if letter in self.letters:
                    out.append(Arm(position, code, digit, self.letters[letter]))
        return out


ARM_SCHEMA = T.StructType([
    T.StructField("book_id", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("ordering", T.StringType()),
    T.StructField("digit", T.StringType()),
    T.StructField("form", T.StringType()),
    T.StructField("ord", T.IntegerType()),
    T.StructField("label", T.StringType()),
])

_FIRST_SCHEMA = T.StructType([
    T.StructField("__b", T.StringType()),
    T.StructField("__o", T.StringType()),
    T.StructField("__d", T.StringType()),
    T.StructField("__m", T.BooleanType()),
    T.StructField("__label", T.StringType()),
])

_LATER_SCHEMA = T.StructType([
    T.StructField("__b", T.StringType()),
    T.StructField("__o", T.StringType()),
    T.StructField("__arms", T.ArrayType(T.StructType([
        T.StructField("d", T.StringType()),
        T.StructField("l", T.StringType()),
    ]))),
])


@dataclass
class Codebook:
    """Books of ordered arms, keyed by book id."""

    books: dict[str, list[Arm]] = field(default_factory=dict)

    def add(self, book_id: str, arms: Iterable[Arm]) -> Codebook:
        arms = list(arms)
        bad = [a for a in arms if a.form not in FORMS or a.position not in (1, 2)]
        if bad:
            raise ValueError(f"bad arms: {bad}")
        self.books.setdefault(book_id, []).extend(arms)
        return self

    def rows(self):
        for book_id, arms in self.books.items():
            for ord_, a in enumerate(arms):
                yield (book_id, a.position, a.ordering, a.digit, a.form, ord_, a.label)

    def to_df(self, spark) -> DataFrame:
        return rule_table(spark, self.rows(), ARM_SCHEMA)

    def first_rows(self):
        """(book, ordering, digit, has further keys) -> label, lowest arm first."""
        out = {}
        for book_id, arms in self.books.items():
            for a in arms:
                if a.position != 1:
                    continue
                for multi in {"both": (True, False), "prefix": (True,), "exact": (False,)}[a.form]:
                    out.setdefault((book_id, a.ordering, a.digit, multi), a.label)
        return [(*k, v) for k, v in out.items()]

    def later_rows(self):
        out = defaultdict(dict)
        for book_id, arms in self.books.items():
            for a in arms:
                if a.position == 2:
                    out[(book_id, a.ordering)].setdefault(a.digit, a.label)
        return [(*k, [{"d": d, "l": lab} for d, lab in v.items()]) for k, v in out.items()]

    def conflicts(self) -> list[tuple]:
        """Arms that repeat an earlier key with another label (never reached)."""
        seen, out = {}, []
        for book_id, arms in self.books.items():
            for a in arms:
                key = (book_id, a.position, a.ordering, a.digit, a.form)
                if seen.setdefault(key, a.label) != a.label:
                    out.append((*key, a.label))
        return out


def _first_lookup(df: DataFrame, book: Codebook | DataFrame) -> DataFrame:
    if isinstance(book, Codebook):
        return rule_table(df.sparkSession, book.first_rows(), _FIRST_SCHEMA)
    multi = F.when(F.col("form") == "prefix", F.array(F.lit(True))) \
        .when(F.col("form") == "exact", F.array(F.lit(False))) \
        .otherwise(F.array(F.lit(True), F.lit(False)))
    return broadcast_if_small(
        book.filter(F.col("position") == 1)
        .select("book_id", "ordering", "digit", F.explode(multi).alias("__m"), "ord", "label")
        .groupBy(F.col("book_id").alias("__b"), F.col("ordering").alias("__o"),
                 F.col("digit").alias("__d"), "__m")
        .agg(F.min_by("label", "ord").alias("__label"))
    )


def _later_lookup(df: DataFrame, book: Codebook | DataFrame) -> DataFrame:
    if isinstance(book, Codebook):
        return rule_table(df.sparkSession, book.later_rows(), _LATER_SCHEMA)
    # Arms of one ordering: at most one per digit, because repeats are cut first.
    arms = (
        book.filter(F.col("position") == 2)
        .groupBy("book_id", "ordering", "digit")
        .agg(F.min("ord").alias("ord"), F.min_by("label", "ord").alias("label"))
        .groupBy(F.col("book_id").alias("__b"), F.col("ordering").alias("__o"))
        .agg(F.sort_array(F.collect_list(F.struct("ord", F.col("digit").alias("d"),
                                                  F.col("label").alias("l")))).alias("__arms"))
    )
    return broadcast_if_small(arms)


def _key(literal: str, col: str | None) -> str:
    return fn.text(literal) if col is None else col


def decode_first(df: DataFrame, book: Codebook | DataFrame, book_id: str = "main",
                 ordering: str = "N_PARTY", answer: str = "DTMF_REP", out: str = "RES1",
                 book_col: str | None = None) -> DataFrame:
    """Label of the first key; NULL when no arm fits. ``book_col`` names a book per row.

    The lookup is unique per (book, ordering, digit, has further keys), so the join never
    multiplies rows.
    """
    look = _first_lookup(df, book)
    on = (f"{_key(book_id, book_col)} = __b AND {ordering} = __o "
          f"AND {fn.first_key_sql(answer)} = __d AND {fn.more_keys_sql(answer)} = __m")
    return (
        df.join(look, F.expr(on), "left")
        .withColumn(out, F.col("__label"))
        .drop("__b", "__o", "__d", "__m", "__label")
    )


def decode_later(df: DataFrame, book: Codebook | DataFrame, book_id: str = "main",
                 ordering: str = "N_PARTY", answer: str = "DTMF_REP", out: str = "RES2",
                 book_col: str | None = None) -> DataFrame:
    """Label of a later key. Among the arms whose digit follows some comma, the first one wins."""
    look = _later_lookup(df, book)
    on = f"{_key(book_id, book_col)} = __b AND {ordering} = __o"
    hit = f"get(filter(__arms, a -> contains({answer}, concat(',', a.d))), 0).l"
    return df.join(look, F.expr(on), "left").withColumn(out, F.expr(hit)).drop("__b", "__o", "__arms")


def spelled_sql(ordering: str, answer: str, base: str, letters: str) -> str:
    """First-key label under a spelling rule; ``letters`` is a map of letter to label."""
    key = fn.first_key_sql(answer)
    # The code laid out by key: a short one leaves a gap before its last letter.
    front = f"greatest(length({ordering}) - 1, 3)"
    keys = f"concat(rpad(left({ordering}, length({ordering}) - 1), {front}, ' '), right({ordering}, 1))"
    step = f"pmod(CASE WHEN length({key}) = 1 THEN try_cast({key} AS INT) END - {base}, 10)"
    return f"try_element_at({letters}, substr({keys}, {step} + 1, 1))"


def decode_spelled(df: DataFrame, spelling: Spelling, ordering: str = "N_PARTY",
                   answer: str = "DTMF_REP", out: str = "RES1") -> DataFrame:
    letters = "map(" + ", ".join(fn.text(x) for kv in spelling.letters.items() for x in kv) + ")"
    return df.withColumn(out, F.expr(spelled_sql(ordering, answer, str(spelling.base), letters)))


_VENDOR_SCHEMA = T.StructType([
    T.StructField("__b", T.StringType()),
    T.StructField("__v", T.IntegerType()),
    T.StructField("__seq", T.StringType()),
])


def assign_ordering(df: DataFrame, vendor_map: Mapping, default: str = UNSET_ORDERING,
                    vendor: str = "VENDOR_ID", out: str = "SEQ", branch_col: str | None = None) -> DataFrame:
    """Ordering from the vendor id.

    ``vendor_map`` is ``{ordering: ids}``, or with ``branch_col`` ``{branch: {ordering: ids}}``;
    ids may be quoted. A vendor that no rule names gets ``default``, which no arm matches.
    """
    rows = {}
    for branch, orderings in (vendor_map if branch_col else {"main": vendor_map}).items():
        for code, ids in orderings.items():
            for i in ids:
                rows.setdefault((branch, int(i)), code)
    look = rule_table(df.sparkSession, [(*k, v) for k, v in rows.items()], _VENDOR_SCHEMA)
    on = f"{_key('main', branch_col)} = __b AND {vendor} = __v"
    return (
        df.join(look, F.expr(on), "left")
        .withColumn(out, F.expr(f"coalesce(__seq, {fn.text(default)})"))
        .drop("__b", "__v", "__seq")
    )


def ordering_from_col(df: DataFrame, column: str = "PARTY", out: str = "SEQ") -> DataFrame:
    return df.withColumn(out, F.col(column))


@dataclass(frozen=True)
class Recode:
    """Rows of the listed constituencies whose label is listed get the label ``to``."""

    pc_ids: tuple[str, ...]
    labels: tuple[str, ...]
    to: str


_RECODE_SCHEMA = T.StructType([
    T.StructField("__b", T.StringType()),
    T.StructField("__p", T.StringType()),
    T.StructField("__l", T.StringType()),
    T.StructField("__to", T.StringType()),
])


def recode(df: DataFrame, rules, pc: str = "PC_ID", label: str = "RES1",
           branch_col: str | None = None) -> DataFrame:
    """Alliance recode; the first rule that fits wins, other labels stay.

    ``rules`` is a list of ``Recode``, or with ``branch_col`` ``{branch: [Recode, ...]}``.
    """
    rows = {}
    for branch, items in (rules if branch_col else {"main": rules}).items():
        for rule in items:
            for p in rule.pc_ids:
                for lab in rule.labels:
                    rows.setdefault((branch, p, lab), rule.to)
    look = rule_table(df.sparkSession, [(*k, v) for k, v in rows.items()], _RECODE_SCHEMA)
    on = f"{_key('main', branch_col)} = __b AND {pc} = __p AND {label} = __l"
    return (
        df.join(look, F.expr(on), "left")
        .withColumn(label, F.expr(f"coalesce(__to, {label})"))
        .drop("__b", "__p", "__l", "__to")
    )
