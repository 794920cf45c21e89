"""Ready specs of the survey rounds, built from a small table of option letters by rule.

EP and PP rounds follow the campaign name and the spelling of the ordering codes, so a state
needs its letters and, where a question changed, the date or constituency of the change. Books are
closed: ``orderings`` lists the codes that were really read out, by state or branch, and a state
that it leaves out is not in the registry. ``open_codes`` asks for open books, which decode every
code that can be written with a state's letters.

BC rounds depend on a calling schedule (which vendor read which ordering in which
constituencies). It is a parameter: ``bc_registry(schedule)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import fields, replace

from pyspark.sql import DataFrame

from surveyscore.operators.decode import Arm, Codebook, Recode, Spelling
from surveyscore.plans.spec import Branch, Registry, StateRoundSpec

# Option letters read out in every state.
COMMON = {"B": "BJP", "I": "INC", "O": "OTHERS"}

# Further option letters by state key.
LETTERS = {
    "ap": {"C": "CPI", "J": "JSP", "M": "CPIM", "T": "TDP+", "Y": "YSRCP"},
    "asm": {"A": "AIUDF", "D": "ASDC", "G": "AGP", "J": "AJP", "P": "BPF", "S": "GSP", "T": "TMC", "U": "UPPL"},
    "br": {"A": "AIMIM", "C": "CPI", "H": "HAM", "J": "JDU", "L": "LJP", "M": "BSP", "N": "IND", "P": "CPIM",
           "R": "RJD", "V": "VIP", "X": "CPIML", "Y": "RLM", "Z": "IND2"},
    "cg": {},
    "ch": {},
    "dl": {"A": "AAP"},
    "ga": {},
    "gj": {"A": "AAP"},
    "hp": {},
    "tn": {"A": "AIADMK", "C": "CPI", "D": "DMK", "K": "AMMK", "M": "CPIM", "N": "OPS", "P": "PMK", "T": "NTK",
           "U": "IUML", "V": "VCK", "X": "DMDK", "Y": "MDMK", "Z": "TMC(M)"},
    "hr": {"A": "AAP", "J": "JJP", "L": "INLD"},
    "jh": {"A": "AJSUP", "C": "CPI (ML)", "J": "JMM", "N": "IND", "R": "RJD"},
    "ka": {"J": "JDS"},
    "kl": {"C": "CPI", "D": "BDJS", "E": "KEC", "J": "KC (J)", "K": "KC (M)", "M": "CPIM", "N": "IND", "P": "BSP",
           "R": "RSP", "S": "SUCI(S)", "U": "IUML"},
    "mh": {"A": "BVA", "C": "OBCBP", "D": "IND", "F": "AIFB", "H": "SS(SHS)", "M": "BSP", "N": "NCP", "P": "NCPSP",
           "R": "RSPS", "S": "SS(SHS)", "U": "SS(UBT)", "V": "VBA", "X": "IND2"},
    "mp": {"A": "AIFB", "M": "BSP"},
    "od": {"C": "CPI", "D": "BJD", "J": "JMM", "M": "CPIM", "N": "IND"},
    "pb": {"A": "AAP", "D": "SAD(A)", "M": "BSP", "N": "IND", "S": "SAD"},
    "rj": {"A": "BAP", "C": "CPIM", "M": "BSP", "N": "IND", "R": "RLP"},
    "tg": {"A": "AIMIM", "R": "BRS"},
    "uk": {"N": "IND"},
    "up": {"A": "AD", "M": "BSP", "N": "IND", "P": "SBSP", "R": "RLD", "S": "SP", "T": "AITC", "Z": "ASP"},
    "wb": {"A": "AITC", "C": "CPI", "F": "AIFB", "M": "CPIM", "R": "RSP", "T": "AITC"},
}
STATES = tuple(LETTERS)

# States whose questions started at key 3 in round EP; all others start at key 5.
EP_BASE_3 = ("ch", "dl", "hp", "hr", "pb")

# State names as the raw calls carry them, matched without case. A branch that asks for
# another pattern names it itself.
STATE_NAMES = {
    "ap": "Andhr%", "asm": "Assa%", "br": "Bihar%", "cg": "Chhatt%", "ch": "Chandigarh%", "dl": "Delhi%",
    "ga": "Goa%", "gj": "Gujarat%", "hp": "Himachal%", "tn": "Tamil%", "hr": "Haryana%", "jh": "Jharkhand%",
    "ka": "Karna%", "kl": "Kera%", "mh": "Mahara%", "mp": "Madhy%", "od": "Odi%", "pb": "Punjab%", "rj": "Rajas%",
    "tg": "Telan%", "uk": "Uttara%", "up": "Uttar%", "wb": "West%",
}


def state_code(state: str) -> str:
    return "AS" if state == "asm" else state.upper()


def spelling(state: str, base: int = 5, **letters: str) -> Spelling:
    return Spelling(base, {**COMMON, **LETTERS[state], **letters})


def books() -> Codebook:
    """Arms of the codes that do not follow their state's spelling.

    Fixed values: the codes, and the keys that their letters stand on, one key per letter.
    """
    book = Codebook()
    jh = spelling("jh", A="AJSU")
    book.add("jh", jh.arms(["JANO", "AJNO"]))
    mh = spelling("mh", N="IND")
    book.add("mh", mh.arms(["HUVNO", "UHVNO"]))
    book.add("mh_late", mh.arms(["HUVNO", "UHVNO"]) + spelling("mh", M="AIMIM").arms(["UHDMV"]))

    # In this state "others" stays on key 9 and the third option is on 7 or on 8.
    wb = spelling("wb")
    five = ["ABIFO", "BAIFO", "BTIFO", "TBIFO"]
    on_8 = ["BTMO", "TBMO", "BTRO", "TBRO"]
    on_7 = ["ABCO", "BACO", "ABIO", "BAIO", "ABMO", "BAMO", "IABO", "IBAO", "RBAO"]
    late = ["ABRO", "BARO"]
    book.add("wb_ep", wb.arms(five) + wb.arms(on_8 + late, "5689") + wb.arms(on_7, "5679"))
    book.add("wb_ep_late", wb.arms(five) + wb.arms(on_8, "5689") + wb.arms(on_7 + late + ["ABFO", "BAFO"], "5679"))
    book.add("wb_pp", wb.arms(five + ["ABICO", "BAICO"]))
    book.add("wb_pp", wb.arms(on_8 + late + ["ABCO", "BACO", "ABFO", "BAFO", "ABMO", "BAMO"], "5689"))
    for code in ("ABIO", "BAIO"):
        # Kept as observed: 7 counts before a further key, 8 counts alone.
        rest = [a for a in wb.arms([code], "5679") if a.digit != "7"]
        book.add("wb_pp", rest + [Arm(1, code, "7", "INC", "prefix"), Arm(1, code, "8", "INC", "exact")])

    # Second question of round PP: the same spelling in most states.
    for state, codes in {"cg": ["BIO", "IBO"], "ch": ["BIO", "IBO"], "gj": ["BIO", "IBO"], "hp": ["BIO", "IBO"],
                         "mp": ["BIO", "IBO"], "od": ["BDIO", "DBIO"]}.items():
        book.add(f"{state}_pp", spelling(state).arms(codes, position=2))
    second = {"BIO": ["BIO", "BIMO", "BINO", "BCMO"], "IBO": ["IBO", "IBMO", "IBNO", "CBMO"]}
    for asked, codes in second.items():
        for a in spelling("rj").arms([asked], position=2):
            book.add("rj_pp", [replace(a, ordering=code) for code in codes])
    return book


def _closed(registry: Registry, orderings: Mapping[str, Iterable[str]] | None, open_codes: bool) -> Registry:
    """Replace spelled books by arms of the listed codes, ``{branch id or state: codes}``."""
    if orderings is None and not open_codes:
        raise ValueError("list the orderings that were read out, or ask for open_codes=True")
    orderings = orderings or {}
    out = Registry(books=registry.books)
    for s in registry.select(registry.keys()):
        unlisted = [b for b in s.branches if b.spelling is not None and b.branch_id not in orderings and s.state not in orderings]
        if unlisted and not open_codes:
            continue
        branches = []
        for b in s.branches:
            codes = orderings.get(b.branch_id, orderings.get(s.state))
            if codes is not None and b.spelling is not None:
                known = out.books.books.get(b.book, []) if b.book else []
                taken = {a.ordering for a in known if a.position == 1}
                arms = b.spelling.arms([c for c in codes if c not in taken])
                book_id = f"{b.branch_id}_closed"
                out.books.add(book_id, [*known, *arms])
                b = replace(b, book=book_id, spelling=None)
            branches.append(b)
        out.add(replace(s, branches=tuple(branches)))
    return out


def ep_registry(orderings: Mapping[str, Iterable[str]] | None = None, open_codes: bool = False) -> Registry:
    """Round EP: latest call per number; where a question changed, again across the parts."""
    reg = Registry(books=books())
    # Parts of a state's round, by date or constituency.
    parts = {
        "mh": [{"start": "2024-04-19", "end": "2024-05-31", "book": "mh", "spelling": spelling("mh", M="AIMIM")},
               {"start": "2024-05-31", "book": "mh_late"}],
        "od": [{"start": "2024-04-19", "end": "2024-06-01"}, {"start": "2024-06-01", "spelling": spelling("od", 3)}],
        "pb": [{"start": "2024-04-19", "pc_not_in": (12,)}, {"start": "2024-04-19", "pc_in": (12,)}],
        "up": [{"start": "2024-04-19"}, {"start": "2024-05-20"}],
        "wb": [{"start": "2024-04-19", "end": "2024-06-01", "book": "wb_ep", "spelling": None},
               {"start": "2024-06-01", "book": "wb_ep_late", "spelling": None}],
        "jh": [{"book": "jh"}],
    }
    for state in STATES:
        code = state_code(state)
        default = {"spelling": spelling(state, 3 if state in EP_BASE_3 else 5)}
        branches = tuple(
            Branch(f"ep_{state}_{i}", (f"{code}-EP%",), **{**default, **part})
            for i, part in enumerate(parts.get(state, [{}]))
        )
        reg.add(StateRoundSpec(state, "EP", branches, dedup_after_union=len(branches) > 1, date_only=True))
    return _closed(reg, orderings, open_codes)


def pp_registry(orderings: Mapping[str, Iterable[str]] | None = None, open_codes: bool = False) -> Registry:
    """Round PP: latest call in most states, column-wise maximum per number in seven."""
    reg = Registry(books=books())
    pb = ("PB-PP%", "PB-AC%")
    tn = {"campaign_like": ("TN-PP-%",), "start": "2024-04-05"}
    second = {"later_keys": True}
    # Parts of a state's round, by date or constituency, and what differs in them.
    parts = {
        "br": [{"spelling": spelling("br", X="CPI(ML)")}],
        "cg": [{"book": "cg_pp", **second}],
        "ch": [{"book": "ch_pp", **second}],
        "dl": [{"end": "2024-05-23"}, {"start": "2024-05-23", "spelling": spelling("dl", 3)}],
        "gj": [{"book": "gj_pp", **second}],
        "hp": [{"campaign_not_like": ("HP-PP-AC%",), "book": "hp_pp", **second}],
        "hr": [{"end": "2024-05-22"}, {"start": "2024-05-22", "spelling": spelling("hr", 3)}],
        "mh": [{"pc_not_in": (21, 22, 25, 27, 31)}, {"pc_in": (21, 22, 25, 27, 31)}],
        "mp": [{"pc_not_in": (1,), "book": "mp_pp", **second}, {"pc_not_in": (1,)}, {"pc_in": (1,)}],
        "od": [{"pc_in": (17,), "book": "od_pp", **second}, {"pc_not_in": (17,)}],
        "pb": [{"campaign_like": pb, "end": "2024-05-21", "pc_not_in": (12,)},
               {"campaign_like": pb, "end": "2024-05-21", "pc_in": (12,)},
               {"campaign_like": pb, "start": "2024-05-21", "pc_in": (7,), "spelling": spelling("pb", 3)},
               {"campaign_like": pb, "start": "2024-05-29", "pc_in": (6, 8)}],
        "rj": [{"state_prefix": "Rajasth%", "start": "2024-03-25", "book": "rj_pp", **second}],
        "tg": [{"start": "2024-04-05"}],
        "tn": [{"campaign_like": ("TN-%",), "start": "2024-03-22", "end": "2024-04-01", "pc_in": (20,),
                "ordering": "vendor", "vendors": {"NDABO": (2,), "ABDNO": (4,), "DBANO": (5,), "BADNO": (9,)},
                "spelling": spelling("tn", N="NTK"), "exclude_numbers_of": "pp_tn_1"},
               {**tn, "pc_in": (20,)}, {**tn, "pc_in": (3, 19, 37)}, {**tn, "pc_in": (38, 39)},
               {**tn, "pc_not_in": (3, 19, 20, 37, 38, 39)}],
        "uk": [{"start": "2024-04-05"}],
        "up": [{"start": "2024-04-05", "post_pc_not_in": (37, 79, 80)},
               {"start": "2024-05-16", "post_pc_in": (37,), "post_pc_not_in": (79, 80)},
               {"start": "2024-05-25", "post_pc_in": (79, 80), "spelling": spelling("up", 3)}],
        "wb": [{"start": "2024-04-05", "book": "wb_pp", "spelling": None}],
    }
    collapsed = ("rj", "tg", "tn", "uk", "up", "wb")
    for state in STATES:
        code, by_max = state_code(state), state in collapsed
        default = {"campaign_like": (f"{code}-PP-%" if by_max else f"{code}-PP%",), "spelling": spelling(state)}
        if by_max:
            default |= {"dedup": "colmax", "state_prefix": STATE_NAMES[state]}
        branches = tuple(
            Branch(f"pp_{state}_{i}", **{**default, **part}) for i, part in enumerate(parts.get(state, [{}]))
        )
        union = len(branches) > 1 and not by_max
        reg.add(StateRoundSpec(state, "PP", branches, dedup_after_union=union, date_only=not by_max))
    return _closed(reg, orderings, open_codes)


def bc_registry(schedule: Iterable[Mapping], second: Codebook | None = None) -> Registry:
    """Round BC from its calling schedule.

    Each entry names a ``state`` and what differs from the usual branch: ``q2_type``, ``pc_in``,
    ``vendors`` (``{ordering: vendor ids}``), dates, letters, or any other ``Branch`` field. The
    usual branch takes the column-wise maximum per number over calls of ``XX-BC-PC%``, orders by
    vendor, and checks the AC against the state's geography. ``second`` holds the arms of the
    second question; name its book in the entry.
    """
    reg = Registry(books=second or Codebook())
    by_state: dict[str, list[Branch]] = {}
    merged = {"hr", "mp", "pb"}  # fixed values: states with one response per number across branches
    for entry in schedule:
        entry = dict(entry)
        state, letters, base = entry.pop("state"), entry.pop("letters", {}), entry.pop("base", 5)
        group = by_state.setdefault(state, [])
        usual = {
            "campaign_like": (f"{state_code(state)}-BC-PC%",), "state_prefix": STATE_NAMES[state],
            "dedup": "colmax", "ordering": "vendor", "spelling": spelling(state, base, **letters),
            "geo": "semi", "geo_state": state_code(state), "later_keys": "book" in entry,
        }
        group.append(Branch(f"bc_{state}_{len(group)}", **{**usual, **entry}))
    for state, branches in by_state.items():
        reg.add(StateRoundSpec(state, "BC", tuple(branches), dedup_after_union=state in merged))
    return reg


def read_schedule(df: DataFrame) -> list[dict]:
    """Calling schedule from a stored table with one row per (branch, ordering).

    Columns: ``branch``, ``state``, ``ordering`` and ``vendor_ids`` (both null for a branch that
    does not order by vendor), and any field of ``Branch``, ``letters`` (a map) or ``base``. Lists
    are arrays, or text with commas between the values. An unknown column, or rows of one branch
    that disagree, are errors. Branches are conditions of a plan, so the table is read whole.
    """
    lists = {f.name: int if "int" in str(f.type) else str for f in fields(Branch)
             if str(f.type).startswith("tuple[") and f.name != "recode"}
    known = {"branch", "state", "ordering", "vendor_ids", "letters", "base", "ordering_from"} | {f.name for f in fields(Branch)}
    unknown = [c for c in df.columns if c not in known - {"vendors", "branch_id", "spelling"}]
    if unknown:
        raise ValueError(f"unknown columns of a schedule: {unknown}")

    def listed(value, kind) -> tuple:
        parts = value.split(",") if isinstance(value, str) else value
        return tuple(kind(p.strip() if isinstance(p, str) else p) for p in parts)

    entries: dict[str, dict] = {}
    for r in df.toLocalIterator():
        row = {k: v for k, v in r.asDict(recursive=True).items() if v not in (None, "")}
        branch, code, ids = row.pop("branch"), row.pop("ordering", None), row.pop("vendor_ids", None)
        if "ordering_from" in row:
            row["ordering"] = row.pop("ordering_from")
        row |= {name: listed(row[name], kind) for name, kind in lists.items() if name in row}
        if "recode" in row:
            row["recode"] = tuple(Recode(tuple(x["pc_ids"]), tuple(x["labels"]), x["to"]) for x in row["recode"])
        entry = entries.setdefault(branch, row | {"vendors": {}})
        if {k: v for k, v in entry.items() if k != "vendors"} != row:
            raise ValueError(f"rows of branch {branch} disagree")
        if (code is None) != (ids is None):
            raise ValueError(f"branch {branch}: ordering and vendor_ids go together")
        if code is not None:
            entry["vendors"][code] = entry["vendors"].get(code, ()) + listed(str(ids) if isinstance(ids, int) else ids, int)
    return [entries[b] for b in sorted(entries)]


def merge(*registries: Registry) -> Registry:
    """One registry of several, so that all rounds can run together."""
    book = Codebook()
    for r in registries:
        for book_id, arms in r.books.books.items():
            if book.books.get(book_id, arms) != arms:
                raise ValueError(f"book {book_id} differs between registries")
            book.books[book_id] = arms
    return Registry([s for r in registries for s in r.select(r.keys())], book)
