"""Survey rounds as data: branches, state specs, and a registry to pick them from."""

from __future__ import annotations

import datetime
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame

from surveyscore.operators.decode import Codebook, Recode, Spelling

_MOMENT = re.compile(r"(\d{4})-(\d{1,2})-(\d{1,2})(?:[ T](\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:\.(\d{1,6}))?)?)?")


def moment(value) -> str | None:
    """A date or time in one padded form, so that texts compare as the times do."""
    if value is None:
        return None
    found = _MOMENT.fullmatch(value.strip()) if isinstance(value, str) else None
    if isinstance(value, datetime.datetime):
        at = value
    elif isinstance(value, datetime.date):
        return value.isoformat()
    elif found is None:
        raise ValueError(f"not a date or time: {value!r}")
    else:
        day = [int(x) for x in found.group(1, 2, 3)]
        if found[4] is None:
            return datetime.date(*day).isoformat()
        at = datetime.datetime(*day, *[int(x or 0) for x in found.group(4, 5, 6)], int((found[7] or "").ljust(6, "0") or 0))
    return at.isoformat(" ", "seconds") if not at.microsecond else at.isoformat(" ")


def _listed(name: str, value, kind) -> tuple:
    """A list field; a text in its place is refused, not taken letter by letter."""
    if isinstance(value, (str, bytes)) or isinstance(value, Mapping):
        raise ValueError(f"{name}: {value!r} is not a list")
    return tuple(kind(v) for v in value or ())


@dataclass(frozen=True)
class Branch:
    """One scan condition with its de-duplication, ordering, decoding and checks.

    ``dedup`` is ``latest`` (last call per number, decided before decoding) or ``colmax``
    (column-wise maximum per number, over calls with a valid answer).
    """

    branch_id: str
    campaign_like: tuple[str, ...] = ()
    campaign_not_like: tuple[str, ...] = ()
    state_prefix: str | None = None
    q2_type: str | None = None
    start: str | None = None
    end: str | None = None
    end_inclusive: bool = False
    pc_in: tuple[int, ...] = ()
    pc_not_in: tuple[int, ...] = ()
    pc_known: bool = False
    dedup: str = "latest"
    ordering: str = "n_party"  # or "party", "vendor"
    vendors: Mapping[str, tuple] = field(default_factory=dict)
    book: str | None = None  # book id of explicit arms
    spelling: Spelling | None = None
    later_keys: bool = False
    recode: tuple[Recode, ...] = ()
    geo: str | None = None  # "semi" or "remap"
    geo_state: str | None = None
    post_pc_in: tuple[int, ...] = ()
    post_pc_not_in: tuple[int, ...] = ()
    post_start: str | None = None
    post_end: str | None = None
    exclude_numbers_of: str | None = None
    emit: bool = True

    def __post_init__(self):
        for f in fields(self):
            value = getattr(self, f.name)
            if f.name in ("start", "end", "post_start", "post_end"):
                value = moment(value)
            elif str(f.type).startswith("tuple[int"):
                value = _listed(f.name, value, int)
            elif str(f.type).startswith("tuple[str"):
                value = _listed(f.name, value, str)
            elif f.name == "vendors":
                value = {code: _listed(f"vendors of {code}", ids, int) for code, ids in (value or {}).items()}
                empty = [code for code, ids in value.items() if not ids]
                if empty:
                    raise ValueError(f"{self.branch_id}: no vendor for {empty}")
            object.__setattr__(self, f.name, value)
        if self.dedup not in ("latest", "colmax"):
            raise ValueError(f"{self.branch_id}: dedup {self.dedup!r}")
        if self.ordering not in ("n_party", "party", "vendor"):
            raise ValueError(f"{self.branch_id}: ordering {self.ordering!r}")
        if self.geo not in (None, "semi", "remap") or (self.geo and not self.geo_state):
            raise ValueError(f"{self.branch_id}: geo {self.geo!r} / {self.geo_state!r}")
        if self.book is None and self.spelling is None:
            raise ValueError(f"{self.branch_id}: needs a book or a spelling")


@dataclass(frozen=True)
class StateRoundSpec:
    """All branches of one state in one round."""

    state: str
    round: str
    branches: tuple[Branch, ...]
    dedup_after_union: bool = False
    date_only: bool = False

    @property
    def key(self) -> str:
        return f"{self.round.lower()}_{self.state.lower()}"


def spec_from_dict(data: Mapping) -> StateRoundSpec:
    """Build a spec from plain data (for example parsed JSON), so rounds can live in files."""
    rest = {k: v for k, v in data.items() if k != "branches"}
    return StateRoundSpec(branches=tuple(branch_from_dict(b) for b in data["branches"]), **rest)


def branch_from_dict(data: Mapping) -> Branch:
    """A branch from plain data; an unknown field, or a text where a list is due, is an error."""
    b = dict(data)
    if b.get("spelling") is not None:
        b["spelling"] = Spelling(**b["spelling"])
    if b.get("recode") is not None:
        b["recode"] = tuple(Recode(_listed("pc_ids", r["pc_ids"], str), _listed("labels", r["labels"], str), r["to"])
                            for r in b["recode"])
    return Branch(**b)


# One row per branch. Lists are arrays; a null field takes the branch's default.
BRANCH_TABLE = """
    round string, state string, dedup_after_union boolean, date_only boolean, branch_id string,
    campaign_like array<string>, campaign_not_like array<string>, state_prefix string, q2_type string,
    start string, end string, end_inclusive boolean, pc_in array<int>, pc_not_in array<int>, pc_known boolean,
    dedup string, ordering string, vendors map<string,array<int>>, book string,
    spelling struct<base:int,letters:map<string,string>>, later_keys boolean,
    recode array<struct<pc_ids:array<string>,labels:array<string>,to:string>>, geo string, geo_state string,
    post_pc_in array<int>, post_pc_not_in array<int>, post_start string, post_end string,
    exclude_numbers_of string, emit boolean
"""
_SPEC_FIELDS = ("round", "state", "dedup_after_union", "date_only")


def branch_rows(specs) -> list[dict]:
    """Specs as rows of ``BRANCH_TABLE``."""
    out = []
    for s in specs:
        for b in s.branches:
            row = {f: getattr(s, f) for f in _SPEC_FIELDS} | {f.name: getattr(b, f.name) for f in fields(b)}
            row["spelling"] = b.spelling and {"base": b.spelling.base, "letters": dict(b.spelling.letters)}
            row["recode"] = [{"pc_ids": r.pc_ids, "labels": r.labels, "to": r.to} for r in b.recode]
            out.append(row)
    return out


def read_registry(branches: DataFrame, books=None) -> Registry:
    """Specs from a stored table with columns of ``BRANCH_TABLE`` (any of them may be absent).

    Branches become conditions of a plan, so their table is read by the driver, whole; ``books``
    may stay a stored arm table. Unknown columns and repeated branch ids are errors; branches of a
    state keep the order of their ids.
    """
    specs: dict[tuple, list] = {}
    for r in branches.orderBy("round", "state", "branch_id").toLocalIterator():
        row = {k: v for k, v in r.asDict(recursive=True).items() if v is not None}
        about = {k: row.pop(k) for k in _SPEC_FIELDS if k in row}
        specs.setdefault(tuple(sorted(about.items())), []).append(branch_from_dict(row))
    found = [StateRoundSpec(branches=tuple(b), **dict(about)) for about, b in specs.items()]
    keys = [s.key for s in found]
    ids = [b.branch_id for s in found for b in s.branches]
    for what, names in (("spec", keys), ("branch", ids)):
        if len(set(names)) < len(names):
            raise ValueError(f"{what} listed twice: {sorted({n for n in names if names.count(n) > 1})}")
    return Registry(found, books)


class Registry:
    """Specs by key such as ``ep_ap``, and the books they decode with."""

    def __init__(self, specs=(), books: Codebook | DataFrame | None = None):
        self._specs: dict[str, StateRoundSpec] = {}
        self.books = Codebook() if books is None else books
        for s in specs:
            self.add(s)

    def add(self, spec: StateRoundSpec) -> Registry:
        ids = [b.branch_id for s in self._specs.values() if s.key != spec.key for b in s.branches]
        repeated = {b.branch_id for b in spec.branches} & set(ids)
        if repeated:
            raise ValueError(f"branch ids already used: {sorted(repeated)}")
        self._specs[spec.key] = spec
        return self

    def __contains__(self, key: str) -> bool:
        return key in self._specs

    def keys(self) -> list[str]:
        return list(self._specs)

    def select(self, names, strict: bool = True) -> list[StateRoundSpec]:
        """Specs by name. Strict: a missing name is an error. Lenient: names are trimmed and
        unknown or non-text ones skipped."""
        if strict:
            missing = [n for n in names if n not in self._specs]
            if missing:
                raise KeyError(f"no spec named {missing}")
            return [self._specs[n] for n in names]
        wanted = [n.strip() for n in names if isinstance(n, str)]
        return [self._specs[n] for n in wanted if n in self._specs]

    def rounds(self, states, rounds) -> list[StateRoundSpec]:
        return self.select([f"{r.lower()}_{s.lower()}" for r in rounds for s in states])
