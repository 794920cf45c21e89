"""One callable per operator: ``(spark, sf_dir) -> DataFrame`` over the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyscore import schema as S
from surveyscore.functions import scalars as fn
from surveyscore.operators import combine, decode, dedup, enrich, filters, match, scoring, summaries, temporal
from surveyscore.plans import compare, incremental, presets, report
from surveyscore.plans.rounds import build_by_branch, build_round, build_rounds
from surveyscore.plans.run import com_of, run, score_responses
from surveyscore.plans.spec import Branch, StateRoundSpec
from surveyscore.sources import readers, sinks
from surveyscore.sources.bucketed import store_by_number
from surveyscore.streaming import events as stream
from workload import adapter as A

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# ---- sources and materialisation ---------------------------------------------------------


@query
def scan_campaign(spark, sf):
    return readers.scan_responses(A.raw_calls(spark, sf), "R3-EP").select("CALL_ID", "Campaign_Name", "DTMF_REP")


@query
def scan_many_union(spark, sf):
    raw = A.raw_calls(spark, sf)
    parts = {r: filters.like(raw, "Campaign_Name", f"R_-{r}-%") for r in A.ROUNDS}
    return readers.read_many(parts).select("CALL_ID", "DN", "Campaign_Name", "DTMF_REP")


@query
def dim_region(spark, sf):
    return enrich.region_dim(A.region_map(spark, sf))


@query
def materialise_join(spark, sf):
    base = _base(spark, sf)
    ac, pc = (
        sinks.materialise(_region(spark, sf, scoring.score_base(base, (s,))).withColumn("ROUND", F.lit("ALL")), s)
        for s in ("ac", "pc")
    )
    return filters.project_layout(combine.join_stored(ac, pc), S.STORED_LAYOUT)


def _base(spark, sf, by=()):
    """Counts of all responses, stored: the scopes, rounds and pools of a query read these."""
    return sinks.materialise(scoring.preaggregate(A.responses(spark, sf), by), "counts")


def _region(spark, sf, df):
    return enrich.with_region(df, A.region_map(spark, sf))


# ---- filters and projections -------------------------------------------------------------


@query
def filter_valid_answer(spark, sf):
    return filters.valid_answer(A.raw_calls(spark, sf)).select("CALL_ID", "DTMF_REP")


@query
def filter_campaign_like(spark, sf):
    return filters.like(A.raw_calls(spark, sf), "Campaign_Name", "R_-EP-PC%-LSE").select("CALL_ID", "Campaign_Name")


@query
def filter_campaign_any(spark, sf):
    pats = ["R0-BC-PC%", "R3-PP-%", "%-PC1_-PM"]
    return filters.like_any(A.raw_calls(spark, sf), "Campaign_Name", pats).select("CALL_ID", "Campaign_Name")


@query
def filter_campaign_not_like(spark, sf):
    pats = ["R2-EP%", "R4-%"]
    return filters.not_like(A.raw_calls(spark, sf), "Campaign_Name", pats).select("CALL_ID", "Campaign_Name")


@query
def filter_state_prefix(spark, sf):
    return filters.state_prefix(A.raw_calls(spark, sf), "Middle_e%").select("CALL_ID", "state")


@query
def filter_qtype(spark, sf):
    return filters.question_type(A.raw_calls(spark, sf), "PM_2024").select("CALL_ID", "Q2_Type")


@query
def filter_time_window(spark, sf):
    raw = A.raw_calls(spark, sf)
    half_open = filters.in_time(raw, "1996-02-01", "1997-03-01")
    closed = filters.in_time(raw, "2000-01-01", "2001-01-01", end_inclusive=True)
    return combine.union_all([half_open, closed]).select("CALL_ID", "Start_Time")


@query
def filter_pc_in(spark, sf):
    return filters.pc_in(A.raw_calls(spark, sf), ["2", "7", 11]).select("CALL_ID", "PC_NO")


@query
def filter_pc_not_in(spark, sf):
    raw = filters.pc_known(A.raw_calls(spark, sf))
    return filters.pc_not_in(raw, A.NUMBERS).select("CALL_ID", "PC_NO")


@query
def filter_decoded(spark, sf):
    return filters.drop_undecoded(_decoded(spark, sf)).select("CALL_ID", "RES1")


@query
def filter_post_branch(spark, sf):
    raw = A.raw_calls(spark, sf)
    first = filters.question_type(raw, "LSE_2019")
    second = filters.pc_in(filters.in_time(filters.question_type(raw, "PM_2024"), end="1999-01-01"), range(5, 15))
    always_empty = filters.pc_in(filters.pc_in(raw, [7]), [9, 10])
    return combine.union_all([first, second, always_empty]).select("CALL_ID", "PC_NO", "Q2_Type")


@query
def project_canonical(spark, sf):
    raw = filters.derive_ids(A.raw_calls(spark, sf)).drop("N_PARTY")
    source = raw.withColumnsRenamed({
        "DN": "MOBILE", "Start_Time": "STIME", "DTMF_REP": "RESPONSE", "PART_NO": "BOOTH", "PARTY": "SEQ",
    }).withColumn("RES1", fn.first_key("RESPONSE"))
    return filters.to_canonical(source, date_only=True)


@query
def project_constants(spark, sf):
    raw = A.raw_calls(spark, sf).select("CALL_ID", "DN")
    return filters.with_defaults(raw, RES2="", state_name="Ruritania", VALID_NUM=0, VENDOR_NO=("int", None))


@query
def clean_scores(spark, sf):
    return dedup.distinct_scores(filters.drop_working_cols(A.responses(spark, sf)))


@query
def reorder_scores(spark, sf):
    score = scoring.score_scope(A.responses(spark, sf), "seq_pc")
    return filters.reorder(score, [S.SCOPES["seq_pc"].summary, "N_PARTY", "NOT_THERE", "RES1"])


@query
def wide_layout(spark, sf):
    score = _region(spark, sf, scoring.score_all(A.responses(spark, sf)))
    return filters.project_layout(filters.with_round(score, "ALL"), S.WIDE_LAYOUT)


@query
def tag_round(spark, sf):
    return filters.with_round(A.raw_calls(spark, sf).select("CALL_ID", "DN"), "BC")


# ---- decoding and scalar functions -------------------------------------------------------


def _decoded(spark, sf, book="main"):
    return decode.decode_first(A.raw_calls(spark, sf), A.books(), book)


@query
def decode_first(spark, sf):
    return _decoded(spark, sf).select("CALL_ID", "N_PARTY", "DTMF_REP", "RES1")


@query
def decode_first_forms(spark, sf):
    return _decoded(spark, sf, "mixed").select("CALL_ID", "N_PARTY", "DTMF_REP", "RES1")


@query
def decode_first_stored_book(spark, sf):
    book = sinks.materialise(A.books().to_df(spark), "book")
    out = decode.decode_first(A.raw_calls(spark, sf), book, "mixed")
    return decode.decode_later(out, book, "main").select("CALL_ID", "RES1", "RES2")


@query
def decode_spelled(spark, sf):
    out = decode.decode_spelled(A.raw_calls(spark, sf), A.SPELLING)
    return out.select("CALL_ID", "N_PARTY", "DTMF_REP", "RES1")


@query
def decode_later(spark, sf):
    out = decode.decode_later(A.raw_calls(spark, sf), A.books())
    return out.select("CALL_ID", "N_PARTY", "DTMF_REP", "RES2")


@query
def assign_ordering(spark, sf):
    out = decode.assign_ordering(A.raw_calls(spark, sf), A.VENDORS)
    out = decode.decode_first(out, A.books(), ordering="SEQ")
    return out.select("CALL_ID", "VENDOR_ID", "SEQ", "RES1")


@query
def ordering_from_col(spark, sf):
    out = decode.ordering_from_col(A.raw_calls(spark, sf), "PARTY")
    out = filters.drop_undecoded(decode.decode_first(out, A.books(), ordering="SEQ"))
    return out.select("CALL_ID", "SEQ", "RES1")


@query
def recode_alliance(spark, sf):
    rules = [r for s in A.STATES for r in A.recodes(s)]
    out = filters.derive_ids(filters.drop_undecoded(_decoded(spark, sf)))
    return decode.recode(out, rules).select("CALL_ID", "PC_ID", "RES1")


@query
def derive_ids(spark, sf):
    return filters.derive_ids(A.raw_calls(spark, sf)).select("CALL_ID", "STATE_CODE", "AC_ID", "PC_ID")


@query
def margin_bucket(spark, sf):
    rows = scoring.scope_table(A.responses(spark, sf), "seq_ac")
    return rows.select("AC_ID", "N_PARTY", "RES1", "MARGIN_SEQWISE_AC",
                       fn.margin_bucket("MARGIN_SEQWISE_AC").alias("MARGIN_GROUP_SEQWISE_AC"))


@query
def score_summary(spark, sf):
    return scoring.scope_table(A.responses(spark, sf), "ac").select("AC_ID", "RES1", "SUMMERY_ACWISE")


@query
def score_pct(spark, sf):
    return scoring.percentages(A.responses(spark, sf), "seq_pc")


# ---- de-duplication ----------------------------------------------------------------------


@query
def dedup_latest(spark, sf):
    raw = A.raw_calls(spark, sf).select("DN", "Start_Time", "CALL_ID", "DTMF_REP", "N_PARTY")
    latest = dedup.latest_per_key(raw, "DN", tie=["CALL_ID"])
    return filters.drop_undecoded(decode.decode_first(latest, A.books()))


@query
def dedup_latest_events(spark, sf):
    events = A.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return dedup.latest_per_key(events, "user_id", "ts", tie=["event_id"])


@query
def dedup_latest_union(spark, sf):
    raw = A.raw_calls(spark, sf).select("DN", "Start_Time", "CALL_ID", "DTMF_REP", "N_PARTY", "Q2_Type")
    branches = []
    for q in ("LSE_2019", "PM_2024"):
        latest = dedup.latest_per_key(filters.question_type(raw, q), "DN", tie=["CALL_ID"])
        branches.append(filters.drop_undecoded(decode.decode_first(latest, A.books())))
    return dedup.latest_per_key(combine.union_all(branches), "DN", tie=["CALL_ID"])


@query
def dedup_colmax(spark, sf):
    raw = filters.valid_answer(A.raw_calls(spark, sf))
    cols = ["Campaign_Name", "VENDOR_ID", "Start_Time", "DTMF_REP", "PARTY", "AC_NO", "PC_NO", "PART_NO", "AGE"]
    return dedup.collapse_max(raw, "DN", cols)


# ---- joins -------------------------------------------------------------------------------


@query
def join_geo_semi(spark, sf):
    raw = filters.derive_ids(A.raw_calls(spark, sf))
    return enrich.geo_check(raw, A.geo(spark, sf), ["R0", "R2"]).select("CALL_ID", "AC_NO")


@query
def join_geo_fan_out(spark, sf):
    raw = filters.derive_ids(A.raw_calls(spark, sf))
    return enrich.geo_check(raw, A.geo(spark, sf), ["R0", "R2"], unique=False).select("CALL_ID", "AC_NO")


@query
def join_geo_remap(spark, sf):
    raw = filters.derive_ids(A.raw_calls(spark, sf))
    out = enrich.geo_remap(raw, A.geo_remap(spark, sf), ["R1"])
    return out.select("CALL_ID", "AC_NO", "PC_NO", "PC_ID")


@query
def join_region_left(spark, sf):
    resp = A.responses(spark, sf).select("DN", "ROUND", "AC_ID", "RES1")
    return _region(spark, sf, resp)


@query
def join_region_left2(spark, sf):
    resp = A.responses(spark, sf).select("DN", "ROUND", "AC_ID", "PC_ID", "RES1")
    return enrich.with_region(resp, A.region_map(spark, sf), ("AC_ID", "PC_ID"))


@query
def anti_join_numbers(spark, sf):
    raw = A.raw_calls(spark, sf)
    listed = filters.in_time(filters.like(raw, "Campaign_Name", "%-EP-%"), "1999-01-01")
    return enrich.exclude_numbers(raw, listed).select("CALL_ID", "DN")


@query
def combine_scopes(spark, sf):
    base = _base(spark, sf)
    return combine.combine_scopes([scoring.score_base(base, (s,)) for s in S.SCOPES])


@query
def combine_rounds_wide(spark, sf):
    return combine.combine_rounds_wide(scoring.score_rounds(A.responses(spark, sf)), ["BC", "EP", "PP", "COM"])


@query
def combine_rounds_wide_from_bc(spark, sf):
    long = scoring.score_rounds(A.responses(spark, sf), pooled=None)
    return combine.combine_rounds_wide(long, ["BC", "EP", "PP"], base="BC")


# ---- counts, windows, ranking ------------------------------------------------------------


def _counts(scope):
    def counted(spark, sf):
        return scoring.scope_counts(A.responses(spark, sf), scope)
    QUERIES[f"score_counts_{scope}"] = counted


def _scored(scope):
    def scored(spark, sf):
        return scoring.score_scope(A.responses(spark, sf), scope)
    QUERIES[f"score_scope_{scope}"] = scored


for _s in S.SCOPES:
    _counts(_s)
    _scored(_s)


@query
def score_counts_date(spark, sf):
    return scoring.counts_by_date(A.responses(spark, sf))


@query
def score_counts_region(spark, sf):
    return scoring.counts_by_region(_region(spark, sf, A.responses(spark, sf)))


@query
def score_max_pct(spark, sf):
    return scoring.max_percentage(A.responses(spark, sf), "ac")


@query
def score_winner(spark, sf):
    return scoring.winner(A.responses(spark, sf), "seq_ac")


@query
def score_winner_draw(spark, sf):
    return scoring.winner(A.responses(spark, sf), "seq_ac", on_tie="draw")


@query
def score_runner_up(spark, sf):
    return scoring.runner_up(A.responses(spark, sf), "ac")


@query
def score_runner_up_dense(spark, sf):
    return scoring.runner_up(A.responses(spark, sf), "seq_ac", method="dense")


@query
def score_scope_dense(spark, sf):
    return scoring.score_scope(A.responses(spark, sf), "ac", method="dense")


@query
def score_rounds_dense(spark, sf):
    return scoring.score_rounds(A.responses(spark, sf), scopes=("seq_pc",), method="dense")


@query
def score_margin(spark, sf):
    return scoring.margin(A.responses(spark, sf), "seq_pc")


@query
def score_all(spark, sf):
    return scoring.score_all(A.responses(spark, sf))


# ---- unions, rounds, report --------------------------------------------------------------


@query
def union_branches(spark, sf):
    raw = A.raw_calls(spark, sf).select("CALL_ID", "Campaign_Name", "PC_NO")
    return combine.union_all([
        filters.like(raw, "Campaign_Name", "%-LSE"),
        filters.like(raw, "Campaign_Name", "R1-%"),
        filters.pc_in(raw, A.NUMBERS),
    ])


@query
def pool_rounds(spark, sf):
    return combine.pool_rounds(A.responses(spark, sf).filter(F.col("ROUND").isin(*A.ROUNDS)))


@query
def stack_rounds(spark, sf):
    """COM, BC, EP and PP in all scopes, each scored from the same stored counts."""
    base = _base(spark, sf, ("ROUND",))
    com = filters.with_round(scoring.score_base(base.drop("ROUND")), "COM")
    parts = [scoring.score_base(base.filter(F.col("ROUND") == r), by=("ROUND",)) for r in A.ROUNDS]
    return combine.stack_rounds([com, *parts])


def _rounds(spark, sf, reg, name):
    specs = [s for s in reg.select(reg.keys()) if s.round == name]
    return build_round(A.raw_calls(spark, sf), specs, reg.books, A.geo(spark, sf), A.geo_remap(spark, sf))


@query
def round_bc(spark, sf):
    return _rounds(spark, sf, A.registry(), "BC")


@query
def round_ep(spark, sf):
    return _rounds(spark, sf, A.registry(), "EP")


@query
def round_pp(spark, sf):
    return _rounds(spark, sf, A.registry(), "PP")


@query
def round_pp_party(spark, sf):
    return _rounds(spark, sf, A.party_registry(), "PP")


@query
def round_bc_from_tables(spark, sf):
    """Specs and arms come from stored tables."""
    return _rounds(spark, sf, A.stored_registry(spark), "BC")


@query
def round_unpadded_dates(spark, sf):
    """Two branches whose dates sort otherwise as texts than as times."""
    book = A.books()
    branches = (Branch("d_a", ("R_-EP%",), start="1996-9-05", end="1997-10-1", book="main"),
                Branch("d_b", ("R_-EP%",), start="1996-10-01", end="1997-9-30 00:00", book="main"))
    return build_rounds(A.raw_calls(spark, sf), [StateRoundSpec("ALL", "EP", branches)], book)


def _preset(spark, sf, make, name):
    """A ready round of five states, closed to the orderings that were read out."""
    reg = make(A.PRESET_ORDERINGS)
    specs = reg.rounds([s for s, _, _ in A.PRESET_STATES.values()], [name])
    return build_round(A.preset_calls(spark, sf), specs, reg.books)


@query
def preset_ep(spark, sf):
    return _preset(spark, sf, presets.ep_registry, "EP")


@query
def preset_pp(spark, sf):
    return _preset(spark, sf, presets.pp_registry, "PP")


@query
def round_by_branch(spark, sf):
    reg = A.registry()
    specs = [s for s in reg.select(reg.keys()) if s.round == "BC"]
    return build_by_branch(A.raw_calls(spark, sf), specs, reg.books, A.geo(spark, sf), A.geo_remap(spark, sf))


@query
def round_overlap(spark, sf):
    """A call that fits several branches is counted in each."""
    book = A.books()
    branches = (
        Branch("o_all", ("R_-EP%",), book="main"),
        Branch("o_early", ("R_-EP-PC%",), end="1997-01-01", end_inclusive=True, book="main"),
        Branch("o_party", ("R_-EP%-PM",), ordering="party", book="main"),
    )
    specs = [StateRoundSpec("ALL", "EP", branches)]
    return build_rounds(A.raw_calls(spark, sf), specs, book)


@query
def round_com(spark, sf):
    return com_of(A.responses(spark, sf), A.region_map(spark, sf))


@query
def all_rounds_long(spark, sf):
    return score_responses(A.responses(spark, sf), A.region_map(spark, sf))


@query
def run_all_states(spark, sf):
    """Raw calls of all states and rounds, through the full build, to scored rounds."""
    return run(A.raw_calls(spark, sf), A.registry(), A.STATES, geo=A.geo(spark, sf),
                        geo_remap=A.geo_remap(spark, sf), region=A.region_map(spark, sf))


@query
def run_wide_all_scopes(spark, sf):
    return run(A.raw_calls(spark, sf), A.registry(), A.STATES, form="wide", geo=A.geo(spark, sf),
               geo_remap=A.geo_remap(spark, sf))


@query
def run_by_number(spark, sf):
    """The same with the de-duplicated calls stored in buckets by number."""
    return run(A.raw_calls(spark, sf), A.registry(), A.STATES, geo=A.geo(spark, sf), geo_remap=A.geo_remap(spark, sf),
               region=A.region_map(spark, sf), by_number=True)


@query
def answers_of_two_rounds(spark, sf):
    """How numbers answered in round BC, and how in EP: two stored tables, joined bucket by bucket."""
    resp = A.responses(spark, sf).select("DN", "state", "RES1", "ROUND")
    bc, ep = (store_by_number(resp.where(F.col("ROUND") == r).drop("ROUND"), buckets=8) for r in ("BC", "EP"))
    pairs = bc.join(ep.withColumnsRenamed({"state": "state_ep", "RES1": "answer_ep"}), "DN")
    return pairs.groupBy("state", "state_ep", F.col("RES1").alias("answer_bc"), "answer_ep").agg(F.count("*").alias("numbers"))


def _votes(resp):
    return resp.groupBy("AC_ID", "PC_ID", "N_PARTY", "RES1", "state", "ROUND").agg(F.count("DN").alias("votes"))


@query
def compare_two_runs(spark, sf):
    """Two stored runs, the second without some responses of one state: what was added, removed, changed."""
    resp = sinks.materialise(A.responses(spark, sf), "responses")
    old, new = (sinks.fresh_folder(spark, "run") for _ in range(2))
    compare.save_run(_votes(resp), old)
    compare.save_run(_votes(resp.where("NOT (state = 'EUROPE' AND AGE % 7 = 0)")), new)
    return compare.compare_runs(spark, old, new)


@query
def stream_windows(spark, sf):
    """Events of a stream of several files, out of order and partly repeated, per day and kind."""
    events, folder, target = A.table(spark, sf, "events"), sinks.fresh_folder(spark, "incoming"), sinks.fresh_folder(spark, "windows")
    for k in range(3):  # the second file repeats a part of the first
        part = events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)).isin([k, min(k + 1, 3)] if k != 1 else [0, 1]))
        part.coalesce(1).write.mode("append").parquet(folder)
    stream.count_windows(spark, folder, events.schema, target, delay="4000 days", files_per_batch=1)
    return stream.read_windows(spark, target).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type",
                                                     "n", F.round("total", 4).alias("total"))


@query
def run_incremental(spark, sf):
    """The same from three batches of calls, out of order; the second repeats those of the first."""
    reg, raw, path = A.registry(), A.raw_calls(spark, sf), sinks.fresh_folder(spark, "scores")
    geography = {"geo": A.geo(spark, sf), "geo_remap": A.geo_remap(spark, sf)}
    for own in ([2], [0, 2], [1]):
        incremental.update(path, raw.where(F.pmod(F.xxhash64("CALL_ID"), F.lit(3)).isin(own)), reg.select(reg.keys()), reg.books, **geography)
    scored = enrich.with_region(incremental.stored_scores(spark, path), A.region_map(spark, sf))
    return scored.select(*S.layout(list(S.SCOPES), ("REGION", "ROUND")))


def _long(spark, sf):
    return scoring.score_rounds(A.responses(spark, sf))


@query
def report_total(spark, sf):
    return report.total_rows(_long(spark, sf))


@query
def report_distinct(spark, sf):
    rows = _long(spark, sf)
    states = report.distinct_values(rows, "state").select(F.lit("state").alias("kind"), F.col("state").alias("value"))
    numbers = report.distinct_values(report.slice_rows(rows, state="ASIA"), "AC_NO", numeric=True)
    parties = report.distinct_values(rows, "RES1").select(F.lit("RES1").alias("kind"), F.col("RES1").alias("value"))
    numbers = numbers.select(F.lit("AC_NO").alias("kind"), F.col("AC_NO").cast("string").alias("value"))
    return combine.union_all([states, numbers, parties])


@query
def report_sort(spark, sf):
    return report.sort_rows(_long(spark, sf))


@query
def report_page(spark, sf):
    rows = sinks.materialise(_long(spark, sf), "report")
    return report.page_rows(report.slice_rows(rows, round="COM"), page=3)


@query
def report_slice(spark, sf):
    return report.slice_rows(_long(spark, sf), state="EUROPE", ac_no="37", res1="", round=None)


@query
def report_full(spark, sf):
    """A filtered page with its totals and the sizes of the three lists to choose from."""
    found = report.report(sinks.materialise(_long(spark, sf), "report"), page=2, state="ASIA", round="BC")
    lists = {"n_states": found.states, "n_ac_numbers": found.ac_numbers, "n_parties": found.parties}
    counts = {k: F.lit(v.count()) for k, v in lists.items()}
    return found.rows.withColumns({"total": F.lit(found.total), "pages": F.lit(found.pages), **counts})


# ---- many branches, time, levels -----------------------------------------------------------


@query
def match_stored_branches(spark, sf):
    """Calls per branch, for branches that are derived from the suppliers: one plan for any number."""
    return match.count_branches(A.raw_calls(spark, sf), A.supplier_branches(spark, sf), first="CALL_ID")


@query
def calls_in_windows(spark, sf):
    """Calls of a constituency in each question window of it; some windows are open."""
    windows, points = A.question_windows(spark, sf), A.raw_calls(spark, sf).select("CALL_ID", "PC_NO", "Start_Time")
    found = temporal.interval_join(points, windows, "Start_Time", "opens", "closes", ["PC_NO"], split=100)
    return found.groupBy("window_id").agg(F.count("*").alias("n_calls"), F.max("CALL_ID").alias("last_call"))


@query
def schedule_in_force(spark, sf):
    """Each call with the schedule of its constituency that is in force when it starts."""
    calls = A.raw_calls(spark, sf).select("CALL_ID", F.col("PC_NO").alias("pc"), "Start_Time")
    return temporal.asof_join(calls, A.schedules(spark, sf), "Start_Time", "valid_from", ["pc"], tie="schedule_id")


@query
def call_sessions(spark, sf):
    """Sessions by a gap of 30 minutes, with attempts and the time to the first purchase."""
    events = A.table(spark, sf, "events")
    return temporal.sessions(events, "user_id", "ts", 30, answered="event_type = 'purchase'").withColumnRenamed("n_events", "attempts")


LEVELS = {"state": ("state",), "pc": ("state", "PC_ID"), "ac": ("state", "PC_ID", "AC_ID"),
          "ordering": ("state", "PC_ID", "AC_ID", "N_PARTY"), "all": ()}


@query
def distinct_respondents(spark, sf):
    """Distinct numbers per state, PC, AC, ordering and overall, pooled over rounds stored one by one."""
    resp = sinks.materialise(A.responses(spark, sf), "responses")
    finest = LEVELS["ordering"]
    numbers = summaries.number_respondents(resp, finest)
    stored = [sinks.materialise(summaries.respondent_bitmaps(resp.where(F.col("ROUND") == r), finest, numbers), "bitmaps") for r in A.ROUNDS]
    return summaries.distinct_levels(combine.union_all(stored), LEVELS)


@query
def duration_percentiles(spark, sf):
    """Exact percentiles of a call's price, standing for its duration, per AC, PC, state and overall."""
    calls = A.priced_calls(spark, sf)
    return summaries.percentiles(calls, "duration", {k: v for k, v in A.CALL_LEVELS.items()}, (0.5, 0.9, 0.99))
