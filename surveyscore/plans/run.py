"""Raw calls to scored rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from surveyscore import schema as S
from surveyscore.operators import combine, enrich, filters, scoring
from surveyscore.plans.rounds import SCORED, build_rounds
from surveyscore.plans.spec import Registry


USUAL_ROUNDS = ("BC", "EP", "PP")


def _with_region(score: DataFrame, region: DataFrame | None) -> DataFrame:
    """Region is looked up on score rows, not on responses: it depends on the AC alone, and there
    are far fewer score rows."""
    return score if region is None else enrich.with_region(score, region)


def score_round(resp: DataFrame, name: str, region: DataFrame | None = None, **how) -> DataFrame:
    """Score one round in the wide layout."""
    return filters.with_round(_with_region(scoring.score_all(resp, **how), region), name)


def build_com(ep: DataFrame, pp: DataFrame, bc: DataFrame, region: DataFrame | None = None) -> DataFrame:
    """Pooled round COM of three frames: each is counted on its own, and the counts are summed."""
    base = combine.union_all([scoring.preaggregate(r) for r in (ep, pp, bc)])
    return filters.with_round(_with_region(scoring.score_base(base), region), "COM")


def com_of(resp: DataFrame, region: DataFrame | None = None) -> DataFrame:
    """Pooled round COM of responses that are one frame already: one pass over them."""
    return score_round(resp, "COM", region)


def score_responses(resp: DataFrame, region: DataFrame | None = None, form: str = "long",
                    pooled: str | None = "COM", scopes=tuple(S.SCOPES), rounds=()) -> DataFrame:
    """Score responses tagged with ROUND: every round, and the pooled one, in a single pass.

    The wide form has columns for the usual rounds and any further ``rounds``; a round of the data
    that is not among them is an error when the result is read.
    """
    long = _with_region(scoring.score_rounds(resp, pooled, scopes), region)
    tail = (*(["REGION"] if region is not None else []), "ROUND")
    long = long.select(*S.layout(list(scopes), tuple(tail)))
    if form == "long":
        return long
    if form != "wide":
        raise ValueError("form is 'long' or 'wide'")
    listed = [*USUAL_ROUNDS, *rounds, *([pooled] if pooled else [])]
    return combine.combine_rounds_wide(long, list(dict.fromkeys(listed)))


def run(raw: DataFrame, registry: Registry, states, rounds=USUAL_ROUNDS, form: str = "long",
        geo=None, geo_remap=None, region=None, pooled: str | None = "COM", by_number: bool = False) -> DataFrame:
    """All requested rounds of the requested states, scored.

    ``by_number`` stores the de-duplicated calls in buckets, as in ``build_rounds``.
    """
    specs = registry.rounds(states, rounds)
    resp = build_rounds(raw, specs, registry.books, geo, geo_remap, tie=SCORED, by_number=by_number)
    return score_responses(resp, region, form, pooled, rounds=[s.round for s in specs])
