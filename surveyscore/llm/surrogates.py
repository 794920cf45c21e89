"""Surrogates for personal data: detected entities get keyed replacements of their own kind.

A surrogate follows from a secret key, the entity's kind and its normal form, so an entity gets the
same one in every document and in every way of writing it. It keeps kind, script, gender and format:
separators, letter case, digit counts, country codes and whether a check digit holds. A name is
known by its word alone: whether it is a surname, and its gender, are settled over the table, and
mentions without title in a document that has the name with one are replaced too. Surrogates
are proposed for the distinct entities of the whole table and checked there: none may be an entity
that occurs, or be shared by two. Those that must be drawn again, and names that occur in several
roles, are joined to their documents; all others are worked out where the text is, so texts are not shuffled.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import ipaddress
import math
import re
import uuid
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from surveyscore.llm.batches import once_per_worker, pieces, released, text_list
from surveyscore.llm.store import store

MANY = 32  # draws after which a surrogate may leave its format, for formats with little room
CACHED = 100_000  # surrogates of a worker's cache; a full cache starts anew

# Titles that announce a name, by the gender they tell.
TITLES = {
    "m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Don", "Signor", "M.", "господин", "κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Signora", "госпожа", "κυρία"),
    "n": ("Dr", "Prof"),
}
_GENDERED = [w for ts in TITLES.values() for t in ts for w in dict.fromkeys((t, t.upper()))]
_TITLE = "|".join(map(re.escape, sorted(_GENDERED, key=len, reverse=True)))
_GENDER = {t.lower(): g for g, ts in TITLES.items() for t in ts}
# Syllables of made-up names by script, and endings by gender.
NAMES = {
    "latin": (["ba", "del", "fi", "gor", "ha", "ka", "len", "mi", "nor", "pa", "ro", "sel", "ti", "var", "wen", "za"],
              {"m": ["ro", "n", "k"], "f": ["ra", "na", "lia"], "n": ["s", "r", "t"], "s": ["mann", "sen", "ley", "ez", "ier"]}),
    "cyrillic": (["ба", "ви", "го", "да", "ка", "ли", "ма", "но", "па", "ру", "се", "ти", "фо", "ха", "ча", "ша"],
                 {"m": ["н", "р", "й"], "f": ["на", "ра", "ля"], "n": ["с", "т", "к"], "s": ["ов", "ин", "енко", "ский", "ук"]}),
    "greek": (["βα", "γι", "δο", "θα", "κα", "λι", "μα", "νο", "πα", "ρο", "σε", "τι", "φο", "χα", "ψε", "ξα"],
              {"m": ["ος", "ης", "ας"], "f": ["α", "η", "ία"], "n": ["ι", "ο", "ε"], "s": ["ίδης", "άκης", "όπουλος", "άς", "ης"]}),
}
# Country calling codes of one and two digits, from the numbering plan; all others have three.
CALLING_CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}
# Characters of an IBAN by country, from the registry.
IBAN_LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}
_CAPITAL = r"[^\W\d_a-zà-öø-ÿа-яα-ωά-ώѐ-џ]"
_NAME = rf"{_CAPITAL}(?:['’]{_CAPITAL})?\w+"
_INITIALS = rf"(?:{_CAPITAL}\.[ ]?)*"  # passed over: a letter names nobody
_KINDS = [
    r"(?P<email>(?<![\w.%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![\w-]))",
    r"(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w))",
    r"(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)|(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]))",
    r"(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)"
    r"|(?<!\w)\(\d{3}\)[ ]?\d{3}[.-]\d{4}(?!\w)|(?<![\w.-])\d{3}([.-])\d{3}\5\d{4}(?![\w-])"
    r"|(?<![\w.+-])0\d(?:[ .]\d{2}){4}(?![\w-]|[ .]\d)|(?<![\w.+-])0\d{2,4}[ /]\d{5,8}(?![\w-]|[ .]\d))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<number>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]))",
    rf"(?P<person>(?<!\w)(?P<title>{_TITLE})\.?[ ](?:(?P<more>{_TITLE})\.?[ ])*{_INITIALS}(?P<names>{_NAME}(?:[ -]{_INITIALS}{_NAME})*))",
]
PATTERNS = re.compile("|".join(_KINDS))
DIGIT = re.compile(r"\d")
WORD = re.compile(rf"(?<!\w){_NAME}")
WORDS = re.compile(_NAME)
BEGINS = re.compile(r"(?:[.!?…]|\A)[\"'»”)\s]*\Z|\n\s*\Z")  # what stands before the first word of a sentence
KINDS = ["email", "iban", "ip", "phone", "ssn", "number", "person"]


def script(word: str) -> str:
    c = word[0].lower()
    return "cyrillic" if "а" <= c <= "я" or c == "ё" else "greek" if "ά" <= c <= "ώ" else "latin"


def luhn(digits: str) -> bool:
    total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def calling_code(digits: str) -> int:
    """How many digits of an international number are its country's code."""
    return next((n for n in (1, 2) if digits[:n] in CALLING_CODES), 3)


def six(found: str) -> str | None:
    """An IPv6 address with all its groups; None if it is none, or too short to be told from a time."""
    try:
        known = ipaddress.IPv6Address(found).exploded
    except ValueError:
        return None
    return known if len(found.replace(":", "")) >= 4 and DIGIT.search(found) else None


@functools.cache
def patterns(at: bool, digit: bool, title: bool) -> re.Pattern:
    """The patterns that can match; the others' groups stay, so that groups keep their numbers."""
    never = ["(?P<email>(?!))", *["(?!)"] * 2, "(?!)()", *["(?!)"] * 2, "(?P<person>(?!)(?P<title>)(?P<more>)(?P<names>))"]
    can = [at, *[digit] * 5, title]
    named = [n if n.startswith("(?P") else f"(?P<{k}>{n})" for k, n in zip(KINDS, never)]
    return re.compile("|".join(p if c else n for p, c, n in zip(_KINDS, can, named)))


def possible(text: str) -> re.Pattern | None:
    """Patterns for a text: an email has an @, a name a title and every other kind a digit."""
    can = "@" in text, bool(DIGIT.search(text)), any(t in text for t in _GENDERED)
    return patterns(*can) if any(can) else None


def iban_end(found: str) -> int | None:
    """Where the IBAN at the start of a match ends: what follows may look like further groups.

    The country's length comes first, then the longest run of whole groups whose check digits hold.
    """
    ends = [k for k in range(len(found), 11, -1) if k == len(found) or found[k] == " "]
    plain = {k: found[:k].replace(" ", "") for k in ends}
    length = IBAN_LENGTHS.get(found[:2])
    ends.sort(key=lambda k: len(plain[k]) != length)
    return next((k for k in ends if len(plain[k]) > 11 and mod97(plain[k]) == 1), None)


def entities(text: str) -> list[tuple[str, int, int, str]]:
    """Leftmost entities as (kind, start, end, normal form). A name is one entity per word.

    The words after a title are names up to the next title. Elsewhere in the text, a capitalised word
    that is one of these names is a mention of it, in the role it first had.
    """
    out, at, roles = [], 0, {}
    pattern = possible(text)
    while m := pattern and pattern.search(text, at):
        at = m.end()
        kind = m.lastgroup if m.lastgroup in KINDS else next(k for k in KINDS if m[k] is not None)
        found = m[kind]
        if kind == "person":
            gender, start = _GENDER[m["title"].lower()], m.start("names")
            if m["title"].isupper() and m["title"] not in TITLES["m"] and not m["names"][:2].isupper():
                at = start  # an abbreviation before a capitalised word, such as a firm's
                continue
            if gender == "n" and m["more"]:
                gender = _GENDER[m["more"].lower()]
            words = list(WORDS.finditer(m["names"]))
            for k, w in enumerate(words[1:-1], 1):
                if w[0].lower() in _GENDER:
                    words, at = words[:k], start + w.start()
                    break
            for k, w in enumerate(words):
                role = "s" if k == len(words) - 1 else gender
                out.append(("person", start + w.start(), start + w.end(), f"{role}:{w[0].lower()}"))
                roles.setdefault(w[0].lower(), role)
        elif kind == "email":
            out.append((kind, *m.span(), found.lower()))
        elif kind == "ip" and ":" in found:
            known = six(found)
            if known:
                out.append((kind, *m.span(), known))
            else:
                at = m.start() + 1 + found.index(":")  # the rest may hold other entities
        elif kind == "ip":
            if all(int(x) < 256 for x in found.split(".")):
                out.append((kind, *m.span(), ".".join(str(int(x)) for x in found.split("."))))
        elif kind == "iban":
            end = iban_end(found)
            at = m.start() + (end or 4)  # the rest may hold other entities
            if end:
                out.append((kind, m.start(), at, found[:end].replace(" ", "")))
        elif kind == "phone":
            digits = re.sub(r"\D", "", found)
            out.append((kind, *m.span(), f"{calling_code(digits) if found[0] == '+' else 0}:{digits}"))
        else:
            out.append((kind, *m.span(), re.sub(r"\D", "", found)))
    return with_mentions(text, out, roles) if roles else out


def plain_word(name: str, text: str) -> bool:
    """Whether a text has a name more often as a word in lower case than capitalised within a sentence."""
    used = Counter()
    for w in re.finditer(rf"(?<!\w){re.escape(name)}(?!\w)", text, re.IGNORECASE):
        if w[0] == name:
            used["lower"] += 1
        elif not BEGINS.search(text, max(0, w.start() - 4), w.start()):
            used["capital"] += 1
    return used["lower"] > used["capital"]


def with_mentions(text: str, found: list[tuple[str, int, int, str]], roles: dict[str, str]) -> list[tuple[str, int, int, str]]:
    """The entities found, and mentions of the names ``roles`` between them."""
    out, at = [], 0
    common = {w for w in roles if plain_word(w, text)}
    for one in [*found, (None, len(text), len(text), None)]:
        for w in WORD.finditer(text, at, one[1]):
            role = roles.get(w[0].lower())
            if role and w[0].lower() in common and BEGINS.search(text, max(0, w.start() - 4), w.start()):
                continue
            if role and (w.end() == len(text) or not re.match(r"\w", text[w.end()])):
                out.append(("person", *w.span(), f"{role}:{w[0].lower()}"))
        out.append(one)
        at = one[2]
    return out[:-1]


def parted(kind: str, normal: str) -> tuple[str, str]:
    """What an entity is known by, and its role: a name's normal form holds both."""
    return tuple(normal.split(":")[::-1]) if kind == "person" else (normal, "")


def joined(kind: str, normal: str, role: str) -> str:
    return f"{role}:{normal}" if kind == "person" else normal


class Stream:
    """Numbers that follow from the key, the entity and the draw."""

    def __init__(self, key: bytes, kind: str, normal: str, draw: int):
        self.key, self.seed, self.block, self.bytes = key, f"{kind}\0{normal}\0{draw}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.bytes) < 4:
            self.bytes += hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        value, self.bytes = int.from_bytes(self.bytes[:4], "big"), self.bytes[4:]
        return value * n >> 32

    def like(self, text: str) -> str:
        """Letters for letters, digits for digits; a leading digit other than 0 stays other than 0."""
        out = []
        for k, c in enumerate(text):
            if c.isdigit():
                out.append(str(1 + self.below(9) if k == 0 and c != "0" else self.below(10)))
            elif c.isalpha():
                out.append(chr(ord("A" if c.isupper() else "a") + self.below(26)))
            else:
                out.append(c)
        return "".join(out)


def syllables_for(names: int) -> int:
    """Syllables of made-up names, so that few of so many are drawn twice: a hundred times the room."""
    return max(2, math.ceil(math.log(100 * names + 1, 16)))


def surrogate(key: bytes, kind: str, normal: str, draw: int = 0, syllables: int = 2) -> str:
    """Normal form of an entity's replacement; ``syllables`` before the ending of a name."""
    s = Stream(key, kind, parted(kind, normal)[0], draw)
    room = "" if draw < MANY else str(s.below(10 ** (1 + draw // MANY)))
    if kind == "email":
        local, domain = normal.split("@")
        kept = ".".join(domain.split(".")[-2:])
        if kept not in ("example.com", "example.org", "example.net"):  # names that no one can own
            kept = "example"
        labels = domain.split(".")[:-kept.count(".") - 1]
        return "@".join([s.like(local) + room, ".".join([*map(s.like, labels), kept])])
    if kind == "ip" and ":" in normal:  # the range kept for documents
        return ":".join(["2001", "0db8", *[f"{s.below(65536):04x}" for _ in range(6)]])
    if kind == "ip":
        widths = [(0, 10), (10, 90), (100, 156)]
        return ".".join(str(low + s.below(n)) for low, n in (widths[len(x) - 1] if draw < MANY else (0, 256) for x in normal.split(".")))
    if kind == "iban":
        body = s.like(normal[4:]) + room
        return f"{normal[:2]}{98 - mod97(normal[:2] + '00' + body):02d}{body}"
    if kind == "phone":
        size, digits = normal.split(":")
        kept = int(size) or len(digits) - len(digits.lstrip("0"))  # the country's code, or the zeros before an area
        return f"{size}:{digits[:kept]}{s.like(digits[kept:])}{room}"
    if kind == "person":
        role, word = normal.split(":")
        parts, endings = NAMES[script(word)]
        body = "".join(parts[s.below(len(parts))] for _ in range(syllables + draw // MANY))
        return f"{role}:{body}{endings[role][s.below(len(endings[role]))]}"
    body = s.like(normal) + room
    if kind == "number":
        last = int(body[-1])
        digits = [body[:-1] + str((last + k) % 10) for k in range(10)]
        return next(d for d in digits if luhn(d) == luhn(normal))
    return body


def written(kind: str, original: str, normal: str) -> str:
    """A surrogate's normal form in the way that the original is written."""
    if kind == "person":
        word = normal.split(":")[1]
        return word.upper() if original.isupper() and len(original) > 1 else word.capitalize()
    if kind == "email":
        return normal.upper() if original.isupper() else normal
    if kind == "ip":
        new = ipaddress.ip_address(normal).compressed if "::" in original else normal
        return new.upper() if original.isupper() else new
    rest = iter(normal.split(":")[-1])
    out = [c if not c.isalnum() else next(rest, "") for c in original]
    return "".join([*out, *rest])


def find_entities(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, kind, normal, role): the distinct entities of each row that has any; names by their word."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([source.schema["id"], *T.StructType.fromDDL("kind string, normal string, role string").fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                found = [sorted({(k, *parted(k, n)) for k, _, _, n in entities(t)}) for t in text_list(piece.column(1))]
                at = pa.array([r for r, f in enumerate(found) for _ in f], pa.int64())
                rows = [p for f in found for p in f]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(at).cast(arrow.field(0).type), *[pa.array([r[k] for r in rows], pa.string()) for k in range(3)]],
                    schema=arrow)

    return source.mapInArrow(released(run), schema)


def settled(roles):
    """The role of a name of several: a gender that titles agree on, none if they do not, else surname."""
    has = lambda r: F.array_contains(roles, r)
    return F.when(has("n") | has("m") & has("f"), F.when(has("m") & ~has("f"), "m").when(has("f") & ~has("m"), "f").otherwise("n")).when(
        has("m"), "m").when(has("f"), "f").when(has("s"), "s").otherwise("")


def draws(found: DataFrame, key: bytes, syllables: int) -> DataFrame:
    """(kind, normal, role, draw) of names of several roles and of entities whose first surrogate would not do, stored.

    A surrogate that is an entity of the table, or that several would share, is drawn again by all
    but the least of those that share it, until none is left. Names are compared as words, whatever
    their roles.
    """

    @F.pandas_udf("string")
    def propose(kind: pd.Series, normal: pd.Series, role: pd.Series, draw: pd.Series) -> pd.Series:
        return pd.Series([parted(k, surrogate(key, k, joined(k, n, r), d, syllables))[0] for k, n, r, d in zip(kind, normal, role, draw)], dtype=object)

    roles = found.groupBy("kind", "normal").agg(F.collect_set("role").alias("roles"))
    real = store(roles.select("kind", "normal", settled(F.col("roles")).alias("role"), (F.size("roles") > 1).alias("several")), "entities")
    open_ = real.withColumn("draw", F.lit(0))
    own = ["kind", "normal", "role", "several", "draw"]
    taken = None
    while True:
        proposed = store(open_.withColumn("new", propose("kind", "normal", "role", "draw")), "proposed")
        used = real.select("kind", F.col("normal").alias("new"))
        if taken is not None:
            used = used.union(taken.select("kind", "new"))
        first = proposed.groupBy("kind", "new").agg(F.min("normal").alias("first"))
        won = first.join(used, ["kind", "new"], "left_anti")
        kept = store(proposed.join(won, ["kind", "new"]).where("normal = first").select(*own, "new"), "kept")
        taken = kept if taken is None else taken.union(kept)
        lost = store(proposed.join(kept.select("kind", "normal"), ["kind", "normal"], "left_anti")
                     .select(*own[:-1], (F.col("draw") + 1).alias("draw")), "lost")
        if lost.isEmpty():
            return taken.where("draw > 0 or several").select("kind", "normal", "role", "draw")
        open_ = lost


def replace_entities(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts with every detected entity replaced.

    Returns one row per input row: the id, text (null stays null) and spans, an array of (kind,
    start, end, new) with code points of the original text. Kinds: email, iban (with its check
    digits), ip (of both versions), phone (known by its digits and country, however it is spaced), ssn, number (13 to 19 digits; the Luhn digit holds if it held), and person:
    the capitalised words after a title (initials are passed over), the last as surname, the others by
    the title's gender, and their capitalised mentions elsewhere in the document, unless those begin a
    sentence and the document has the word mostly in lower case. Names without any title are not found. A name is its word in any case and role.
    Equal entities of the whole table get equal surrogates, different ones of a kind different
    surrogates, none of which occurs as an entity. Null ids and repeated rows pass through.
    """
    found = store(find_entities(docs, id_col, text_col), "found")
    names = found.where("kind = 'person'").select("normal").distinct().count()
    syllables = syllables_for(names)
    again = draws(found, key, syllables)
    fixes = store(found.drop("role").join(again, ["kind", "normal"]).groupBy("id").agg(
        F.collect_set(F.struct("kind", "normal", "role", "draw")).alias("fixes")), "fixes")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    source = source.join(fixes.select(F.col("id").alias("fixed"), "fixes"), F.col("id").eqNullSafe(F.col("fixed")), "left").drop("fixed")
    schema = T.StructType([T.StructField(id_col, source.schema["id"].dataType), *T.StructType.fromDDL(
        "text string, spans array<struct<kind:string,start:int,end:int,new:string>>").fields])
    arrow = to_arrow_schema(schema)
    name = uuid.uuid4().hex

    def run(batches):
        cache = once_per_worker(name, dict)
        for batch in batches:
            for piece in pieces(batch):
                out = [replaced(t, {(f["kind"], f["normal"]): (f["role"], f["draw"]) for f in fixed or ()}, cache)
                       for t, fixed in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist())]
                texts, spans = zip(*out)
                yield pa.RecordBatch.from_arrays([piece.column(0).cast(arrow.field(0).type), pa.array(texts, pa.string()),
                                                  pa.array(spans, arrow.field(2).type)], schema=arrow)

    def replaced(text, fixed, cache):
        if text is None:
            return None, []
        parts, at, spans = [], 0, []
        for kind, a, b, normal in entities(text):
            known, role = parted(kind, normal)
            role, draw = fixed.get((kind, known), (role, 0))
            which = kind, joined(kind, known, role), draw
            if which not in cache:
                if len(cache) >= CACHED:
                    cache.clear()
                cache[which] = surrogate(key, *which, syllables)
            new = written(kind, text[a:b], cache[which])
            parts += [text[at:a], new]
            spans.append({"kind": kind, "start": a, "end": b, "new": new})
            at = b
        return "".join([*parts, text[at:]]), spans

    return source.mapInArrow(released(run), schema)
