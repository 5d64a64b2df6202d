"""Assembly of the two profile tables.

``build_profiles`` composes the operators into a *filter profile* (66
columns, for filtering leads) and a *data profile* (57 columns, for display).
Both are lazy DataFrames; ``write_profiles`` materialises shared inputs and
writes them.

Multiplicity follows the original job exactly: joins are not de-duplicated,
so a lead may own several rows (ties of the latest application, fan-out of
joined tables, the self re-join of the attribute lookup).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiprof.codes import (
    APPLICATION_PERIOD_START,
    CUSTOM_ORG_KEY,
    DEFAULT_CODES,
    INTERNAL_FEED_JSON_PATH,
    JOURNEY_COMPLETE_ACTION,
    JOURNEY_MODULE,
    Codes,
)
from entiprof.functions.classify import (
    SourceInputs,
    apply_source,
    cem_folder,
    event_apply_source,
    event_source_name,
    source_name,
    widget_type_key,
)
from entiprof.functions.predicates import (
    first_non_blank,
    json_flag,
    source_lead_predicate,
    valid_name_flag,
    when_flag,
)
from entiprof.operators.aggregates import conditional_span_joined, group_maxes, joined_max, repeat_entities, set_concat, sum_count
from entiprof.operators.latest import (
    LatestTarget,
    first_match,
    group_argmax_row,
    last_id,
    latest_preferred,
    latest_preferred_since,
    latest_rows,
)
from entiprof.operators.lookups import COPIES, JoinStep, attribute_values, join_chain, lookup_fallback, repeat_rows, rows_per_key
from entiprof.operators.ranks import joined_max_by_number, ordered_numbers
from entiprof.operators.skew import Skew, dealt, heavy_values
from entiprof.sources.layout import PUSHED_IDS, id_cover
from entiprof.sources.sinks import Stage, write_tables
from entiprof.sources.snapshots import Snapshots
from entiprof.sources.tables import id_set, has_rows, restrict_to

c = F.col

# ---------------------------------------------------------------- base


# Lead columns the join conditions of the base chain read.
_BASE_KEYS = ("id", "company_id", "candidate_profile_id", "job_loc_id")


# Columns that may gather many leads on one value, by table.
_GATHERING = {
    "lead": ("candidate_profile_id", "job_loc_id", "web_id", "added_by", "referred_by", "detect_language_code", "language_code"),
    "lead_extra": ("job_req_id", "journey_stage_id"),
    "job": ("company_brand_id", "job_family_id"),
    "job_location": ("company_area_id",),
}


def _tasks(t: Mapping[str, DataFrame]) -> int:
    return int(t["lead"].sparkSession.conf.get("spark.sql.shuffle.partitions"))


def measure_skew(t: Mapping[str, DataFrame]) -> dict[str, Mapping[object, int]]:
    """Heavy values of the columns that the chains join on, by the names that the join steps use."""
    lead, extra, job, jloc = (heavy_values(t[name], columns, _tasks(t)) for name, columns in _GATHERING.items())
    out = {f"{a}.{col}": v for a in ("lk", "lead") for col, v in lead.items()} | {f"extra.{col}": v for col, v in extra.items()}
    out |= {f"job.{col}": v for col, v in job.items()} | {f"jloc.{col}": v for col, v in jloc.items()}
    return out | {"job.job_req_id": extra["job_req_id"]}


def _skew(t: Mapping[str, DataFrame], alias: str, heavy: Mapping | None) -> Skew | None:
    if heavy is None:
        return None
    return Skew([f"{alias}.{k}" for k in _BASE_KEYS], heavy)


def _base_steps(t: Mapping[str, DataFrame]) -> dict[str, JoinStep]:
    """The twelve joins of the base chain (R1) by alias, in the original's order."""
    steps = [
        JoinStep(t["lead_extra"], "extra", c("lk.id") == c("extra.lead_id")),
        JoinStep(t["candidate_profile"], "profile", c("lk.candidate_profile_id") == c("profile.id"), key=("lk.candidate_profile_id", "id")),
        JoinStep(
            t["journey_stage"], "jstage",
            (c("extra.journey_stage_id") == c("jstage.id")) & (c("lk.company_id") == c("jstage.company_id")),
            key=("extra.journey_stage_id", "id"), fixed=True,
        ),
        JoinStep(
            t["stage_status"], "sstatus",
            (c("jstage.id") == c("sstatus.stage_id")) & (c("extra.journey_status_id") == c("sstatus.id")),
            key=(("extra.journey_stage_id", c("jstage.id")), "stage_id"), fixed=True,
        ),
        JoinStep(
            t["company_area"], "area",
            (c("lk.job_loc_id") == c("area.job_loc_id")) & (c("lk.company_id") == c("area.company_id")),
            key=("lk.job_loc_id", "job_loc_id"),
        ),
        JoinStep(t["job_loc"], "jl", (c("lk.job_loc_id") == c("jl.id")) & (c("jl.is_deleted") == 0), key=("lk.job_loc_id", "id")),
        JoinStep(t["job"], "job", (c("extra.job_req_id") == c("job.job_req_id")) & (c("job.base_id") > 0), key=("extra.job_req_id", "job_req_id")),
        JoinStep(
            t["job_location"], "jloc",
            (c("job.id") == c("jloc.job_id")) & (c("area.id") == c("jloc.company_area_id")), key=("job.id", "job_id"),
        ),
        JoinStep(t["company_brand"], "brand", (c("job.company_brand_id") == c("brand.id")) & (c("brand.status") == 1), key=("job.company_brand_id", "id")),
        JoinStep(
            t["live_job"], "live",
            (c("job.id") == c("live.job_id"))
            & (c("job.job_req_id") == c("live.job_req_id"))
            & (c("jl.id") == c("live.job_loc_id")),
            key=("job.job_req_id", "job_req_id"),
        ),
        JoinStep(t["event_itv_lead"], "eitv", c("lk.id") == c("eitv.lead_id")),
        JoinStep(t["previous_application"], "prev", c("lk.id") == c("prev.application_id")),
    ]
    return {step.alias: step for step in steps}


def _chained(t: Mapping[str, DataFrame], steps: list[JoinStep], heavy: Mapping | None) -> DataFrame:
    """The lead's join keys through ``steps``, and every lead row with the chain's rows of its own keys."""
    lead = t["lead"]
    narrow = join_chain(lead.select(*_BASE_KEYS).distinct(), "lk", steps, _skew(t, "lk", heavy))
    same = reduce(lambda a, b: a & b, [c(f"lk.{k}").eqNullSafe(c(f"lead.{k}")) for k in _BASE_KEYS])
    return narrow.join(dealt(lead.alias("lead")), same, "inner")


def assemble_base(t: Mapping[str, DataFrame], heavy: Mapping | None = None) -> DataFrame:
    """Lead left-joined to twelve tables (R1), narrow first, wide last.

    The chain runs on the distinct combinations of the lead's join keys (alias
    ``lk``), so the shuffles of the shuffled joins move a few key columns
    instead of the whole lead row. A combination is all that the chain can see of a lead,
    so it identifies the lead's matches whether ids repeat or are NULL, and
    comes out the same when a task is computed again; at the end every lead row (alias
    ``lead``) meets the chain's rows of its own combination, NULLs being equal: a lead
    that stands twice gives each row twice, one without an id stays. Left
    joins whose conditions read only the lead and their own side commute, so this
    order gives the same rows as the original's. ``heavy`` (of :func:`measure_skew`)
    makes the joins on ids that may gather rows salted ones."""
    return _chained(t, list(_base_steps(t).values()), heavy)


#: Of a base with gathered areas: the ids of the areas, the job locations with how many rows have each,
#: for how many rows an area stands, and for how many rows the base row stands.
_AREAS, _PLACES, _TIMES, _ROWS = "__areas", "__places", "__times", "__rows"


def area_sets(t: Mapping[str, DataFrame], heavy: Mapping | None = None) -> tuple[DataFrame, DataFrame]:
    """(job_loc_id, company_id, times, ids): the areas of a place, those that stand ``times`` times each;
    (job_id, job_loc_id, company_id, times, found): the pairs of area and job location that a job has among them."""
    keys = ["job_loc_id", "company_id"]
    area = t["company_area"].dropna(subset=keys).groupBy(*keys, "id").agg(F.count("*").alias("times"))
    sets = area.groupBy(*keys, "times").agg(F.collect_list(F.struct("id")).alias("ids")).withColumn("ids", c("ids.id"))
    step = JoinStep(area, "a", c("a.id") == c("jloc.company_area_id"), key=("jloc.company_area_id", "id"))
    met = join_chain(t["job_location"].where(c("job_id").isNotNull()), "jloc", [step], None if heavy is None else Skew(["jloc.id", "jloc.job_id"], heavy))
    met = met.where(c("a.id").isNotNull()).select("jloc.job_id", "a.job_loc_id", "a.company_id", "a.times", c("a.id").alias("area_id"), c("jloc.id").alias("id"))
    return sets, met.groupBy("job_id", *keys, "times").agg(F.collect_list(F.struct("area_id", "id")).alias("found"))


def gathered_base(t: Mapping[str, DataFrame], heavy: Mapping | None = None) -> DataFrame:
    """:func:`assemble_base` with a lead's areas in one row, in place of a row each (columns ``_AREAS`` to ``_ROWS``).

    A place has more areas the more a company grows, and a row an area went through every later exchange. Here
    the areas join last, as sets; the job locations that the chain finds by job and area are found
    among them beforehand. :func:`filter_rows` and :func:`data_rows` make the rows."""
    steps = _base_steps(t)
    sets, found = area_sets(t, heavy)
    places = (c("lk.job_loc_id") == c("found.job_loc_id")) & (c("lk.company_id") == c("found.company_id")) & (c("area.times") == c("found.times"))
    area = steps.pop("area")
    del steps["jloc"]
    last = [JoinStep(sets, "area", area.on, key=area.key), JoinStep(found, "found", (c("job.id") == c("found.job_id")) & places, key=("job.id", "job_id"))]
    base = _chained(t, [*steps.values(), *last], heavy)
    none, times = c("found.found").isNull(), F.coalesce("area.times", F.lit(1).cast("long"))
    ids = F.coalesce("area.ids", F.array(F.lit(None).cast(sets.schema["ids"].dataType.elementType)))
    alone = F.when(none, ids).otherwise(F.array_except(ids, c("found.found.area_id")))
    job_location = found.schema["found"].dataType.elementType["id"].dataType
    nowhere = F.struct(F.lit(None).cast(job_location).alias("id"), (F.size(alone) * times).alias("rows"))
    somewhere = F.transform("found.found", lambda x: F.struct(x["id"].alias("id"), times.alias("rows")))
    parts = {
        _AREAS: F.when(none, alone).otherwise(F.concat(alone, c("found.found.area_id"))),
        _PLACES: F.when(none, F.array(nowhere)).when(F.size(alone) == 0, somewhere).otherwise(F.concat(F.array(nowhere), somewhere)),
        _TIMES: times,
        _ROWS: times * (F.size(alone) + F.when(none, 0).otherwise(F.size("found.found"))),
    }
    return base.select("*", *[x.alias(name) for name, x in parts.items()])


def filter_rows(df: DataFrame) -> DataFrame:
    """A row of its own for each area; as many equal rows as ``COPIES``."""
    copies = (F.coalesce(COPIES, F.lit(1)) * c(_TIMES)).alias(COPIES)
    kept = [name for name in df.columns if name not in (_AREAS, _TIMES, COPIES)]
    at = [dst for _, dst in FILTER_BASE_COLUMNS].index("area_id")
    return df.select(*kept[:at], F.explode(_AREAS).alias("area_id"), *kept[at:], copies)


def data_rows(df: DataFrame) -> DataFrame:
    """A row of its own for each job location, and one for all areas without; as many equal rows as ``COPIES``."""
    kept = [name for name in df.columns if name not in (_PLACES, COPIES)]
    at = [dst for _, dst in DATA_BASE_COLUMNS].index("job_location_id")
    each = df.select(*kept, COPIES, F.explode(_PLACES).alias("__place"))
    return each.select(*kept[:at], c("__place.id").alias("job_location_id"), *kept[at:], (F.coalesce(COPIES, F.lit(1)) * c("__place.rows")).alias(COPIES))


# Output column names of the two projections are the profile schema (fixed).
FILTER_BASE_COLUMNS = (
    ("lead.id", "lead_id"), ("lead.company_id", "company_id"), ("lead.long_id", "long_id"),
    ("lead.conversation_id", "conversation_id"), ("lead.company_group_id", "company_group_id"),
    ("lead.candidate_profile_id", "candidate_profile_id"), ("lead.apply_type", "lead_apply_type"),
    ("lead.created_at", "lead_created_at"), ("lead.updated_at", "lead_updated_at"),
    ("lead.interviewer_ids", "lead_interviewer_ids"), ("lead.is_valid", "lead_is_valid"),
    ("lead.external_source_id", "lead_external_source_id"), ("lead.referred_by", "lead_referred_by"),
    ("lead.added_by", "lead_added_by"), ("lead.name", "lead_name"), ("lead.phone_number", "lead_phone_number"),
    ("lead.email", "lead_email"), ("lead.status", "lead_status"), ("lead.ip_addr", "ip_addr"),
    ("lead.start_kw", "lead_start_kw"), ("lead.source", "lead_source"), ("lead.tz_str", "lead_tz_str"),
    ("extra.id", "lead_extra_id"), ("jl.location_id", "location_id"), ("area.id", "area_id"),
    ("job.id", "job_id"), ("job.name", "job_name"), ("jl.id", "job_loc_id"), ("brand.id", "job_brand_id"),
    ("live.id", "live_job_id"), ("eitv.id", "event_itv_leads_id"), ("jstage.id", "journey_stage_id"),
    ("sstatus.id", "stage_status_id"), ("extra.application_id", "extra_application_id"),
    ("extra.job_req_id", "extra_job_req_id"), ("extra.job_title", "extra_job_title"),
    ("extra.journey_status_id", "extra_journey_status_id"), ("profile.public_id", "profile_public_id"),
    ("profile.phone_number", "profile_phone_number"), ("profile.email", "profile_email"),
)

DATA_BASE_COLUMNS = (
    ("lead.id", "lead_id"), ("lead.company_id", "company_id"), ("lead.web_id", "widget_id"),
    ("lead.completed", "lead_completed"), ("lead.detect_language_code", "lead_detect_language_code"),
    ("lead.language_code", "lead_language_code"), ("lead.itv_requested_at", "lead_itv_requested_at"),
    ("lead.responsed", "lead_responsed"), ("lead.recent_ai_phone_number", "lead_recent_ai_phone_number"),
    ("lead.past_interviewer_ids", "lead_past_interviewer_ids"), ("lead.opt_in_status", "lead_opt_in_status"),
    ("lead.outbound_accepted", "lead_outbound_accepted"), ("lead.unsubscribed", "lead_unsubscribed"),
    ("lead.last_contacted_at_timestamp", "lead_last_contacted_at_timestamp"),
    ("lead.primary_contact_method", "lead_primary_contact_method"), ("lead.referrer", "lead_referrer"),
    ("prev.id", "previous_applications_id"), ("jloc.id", "job_location_id"), ("eitv.id", "event_itv_id"),
    ("extra.external_info", "extra_external_info"), ("extra.consent_to_marketing", "extra_consent_to_marketing"),
    ("extra.apply_url", "extra_apply_url"), ("extra.journey_candidate_status", "extra_candidate_journey_status"),
    ("extra.itv_scheduling_method", "extra_itv_scheduling_method"),
    ("prev.reapply_type", "previous_application_reapply_type"), ("eitv.checked_in", "event_itv_lead_checked_in"),
    ("eitv.status", "event_itv_lead_status"), ("eitv.selected_time_at", "event_itv_lead_selected_time_at"),
    ("eitv.requested_at", "event_itv_lead_requested_at"),
)

_INT_CASTS = {"extra_itv_scheduling_method"}


def project_filter_columns(codes: Codes = DEFAULT_CODES) -> list[tuple[str, Column]]:
    """The 40 renamed base columns plus the validity flag (R2), by output name."""
    flag = valid_name_flag(c("lead.name"), c("lead.status"), codes.status_removed)
    return [*((dst, c(src)) for src, dst in FILTER_BASE_COLUMNS), ("is_valid_name_and_status", flag)]


def project_data_columns() -> list[tuple[str, Column]]:
    """The 29 renamed base columns by output name; text codes cast with
    ``try_cast`` (bad text gives NULL instead of failing the job under ANSI mode)."""
    return [(dst, c(src).try_cast("int") if dst in _INT_CASTS else c(src)) for src, dst in DATA_BASE_COLUMNS]


def project_filter(base: DataFrame, codes: Codes = DEFAULT_CODES) -> DataFrame:
    return base.select(*[x.alias(name) for name, x in project_filter_columns(codes)])


def project_data(base: DataFrame) -> DataFrame:
    return base.select(*[x.alias(name) for name, x in project_data_columns()])


# ---------------------------------------------------------------- filter-profile steps


# Columns of the applications that the profile reads.
_APPLIED_COLUMNS = (
    "id", "lead_id", "job_req_id", "requisition_id", "job_title", "is_valid", "city", "state", "chat_to_apply_type",
    "created_at", "job_loc_id", "job_id", "extra_data",
)


def picked_applications(t: Mapping[str, DataFrame], since: str = APPLICATION_PERIOD_START) -> DataFrame:
    """Applications that R5 (``is_latest``) or R13 (``in_period``) picks, found together: two reads of the table."""
    valid, invalid = c("is_valid") == 1, c("is_valid") == 0
    targets = [LatestTarget("is_latest", valid), LatestTarget("in_period", valid, invalid, since)]
    return latest_rows(t["applied_job"].select(*_APPLIED_COLUMNS), "lead_id", "created_at", targets)


def latest_application(t: Mapping[str, DataFrame], method: str = "aggregate") -> DataFrame:
    """(lead_id, latest_apply_job_id), ties kept."""
    rows = latest_preferred(t["applied_job"], "lead_id", "created_at", c("is_valid") == 1, method=method)
    return rows.select(c("id").alias("latest_apply_job_id"), "lead_id")


def recorded_counts(t: Mapping[str, DataFrame]) -> DataFrame:
    """Per lead with a completed (status 2) recorded interview: question
    and response counts and the seconds between the first and last response
    (``recorded_within_24h`` is a span in seconds, not a flag)."""
    return conditional_span_joined(
        t["recorded_candidate"], "id", "lead_id", t["recorded_message"], "recorded_itv_candidate_id",
        c("message_type") == 2, "created_at", parent_pred=c("status") == 2,
        question_alias="recorded_question_total", answer_alias="recorded_response_count",
        span_alias="recorded_within_24h",
    )


APPLICATION_COLUMNS = (
    "job_applied_valid_id", "job_applied_requisition_id", "job_applied_log_job_requisition_id",
    "job_applied_log_job_title", "job_applied_log_job_city", "job_applied_log_job_state",
    "job_applied_chat_to_apply_type", "job_applied_created_at", "job_applied_job_loc_id", "job_applied_job_id",
    "job_applied_job_title", "job_applied_reapply_requisition_id", "is_internal_job_feed", "cem_folder",
    "lead_interview_type", "lead_schedule_by", "lead_interview_jobloc_id", "job_applied_shorten_job_id",
)


def application_detail(t: Mapping[str, DataFrame], codes: Codes = DEFAULT_CODES, since: str = APPLICATION_PERIOD_START,
                       picked: DataFrame | None = None, heavy: Mapping | None = None) -> DataFrame:
    """Per lead that has a lead_extra row, its latest application in
    the period (valid preferred) with requisition / title fallbacks, the
    folder code and a few lead fields. ``picked``: those applications, where the
    caller has them."""
    if picked is None:
        aj = t["applied_job"]
        picked = latest_preferred_since(aj, "lead_id", "created_at", c("is_valid") == 1, c("is_valid") == 0, since)
    apps = picked.select(
        "id", "lead_id", "job_req_id", "requisition_id", "job_title", "is_valid", "city", "state",
        "chat_to_apply_type", "created_at", "job_loc_id", "job_id",
        json_flag(c("extra_data"), INTERNAL_FEED_JSON_PATH).alias("is_internal_job_feed"),
    )
    steps = [
        JoinStep(t["lead_extra"], "extra", c("l.id") == c("extra.lead_id"), "inner"),
        JoinStep(apps, "app", c("app.lead_id") == c("l.id")),
        JoinStep(t["job"], "job", (c("job.job_req_id") == c("extra.job_req_id")) & (c("job.base_id") > 0), key=("extra.job_req_id", "job_req_id")),
        JoinStep(t["widget"], "widget", (c("widget.id") == c("l.web_id")) & (c("widget.company_id") == c("l.company_id")), key=(("lead.web_id", c("l.web_id")), "id")),
        JoinStep(t["applied_job_extension"], "ext", c("ext.applied_job_id") == c("app.id"), key=("app.id", "applied_job_id")),
    ]
    j = join_chain(t["lead"], "l", steps, None if heavy is None else Skew(["l.id", "l.company_id", "l.web_id"], heavy))
    valid = c("app.is_valid")

    def not_invalid(value):
        """NULL for an invalid application; otherwise (valid, other, or no
        application at all) the value."""
        return F.when(valid == 0, F.lit(None)).otherwise(value)

    return j.select(
        c("l.id").alias("lead_id"),
        when_flag(valid, c("app.id")).alias("job_applied_valid_id"),
        when_flag(valid, c("app.requisition_id")).alias("job_applied_requisition_id"),
        not_invalid(
            first_non_blank("app.requisition_id", "app.job_req_id", "job.job_req_id", fallback="extra.job_req_id")
        ).alias("job_applied_log_job_requisition_id"),
        not_invalid(first_non_blank("app.job_title", "job.name", fallback="extra.job_title")).alias(
            "job_applied_log_job_title"
        ),
        when_flag(valid, c("app.city")).alias("job_applied_log_job_city"),
        when_flag(valid, c("app.state")).alias("job_applied_log_job_state"),
        when_flag(valid, c("app.chat_to_apply_type")).alias("job_applied_chat_to_apply_type"),
        when_flag(valid, c("app.created_at")).alias("job_applied_created_at"),
        when_flag(valid, c("app.job_loc_id")).alias("job_applied_job_loc_id"),
        when_flag(valid, c("app.job_id")).alias("job_applied_job_id"),
        when_flag(valid, c("app.job_title")).alias("job_applied_job_title"),
        c("app.requisition_id").alias("job_applied_reapply_requisition_id"),
        c("app.is_internal_job_feed").alias("is_internal_job_feed"),
        cem_folder(c("l.source"), c("l.apply_type"), c("l.referred_by"), c("l.web_id"), c("widget.widget_type"),
                   codes).alias("cem_folder"),
        c("l.interview_type").try_cast("int").alias("lead_interview_type"),
        c("l.schedule_by").alias("lead_schedule_by"),
        c("l.interview_jobloc_id").alias("lead_interview_jobloc_id"),
        c("ext.shorten_job_id").alias("job_applied_shorten_job_id"),
    )


# ---------------------------------------------------------------- source star


def source_event(t: Mapping[str, DataFrame], numbers: DataFrame | None = None) -> DataFrame:
    """Per (event company, lead) the max event name. ``numbers``: those of the names, where they are kept."""
    args = (
        t["event_candidate"].alias("ec"), t["event"].alias("e"), c("e.id") == c("ec.event_id"),
        [c("e.company_id").alias("company_id"), c("ec.lead_id").alias("lead_id")], c("e.name"),
    )
    return joined_max(*args) if numbers is None else joined_max_by_number(*args, numbers)


def source_campaign(t: Mapping[str, DataFrame], numbers: DataFrame | None = None) -> DataFrame:
    """R10d: per (campaign company, lead) the max campaign name. ``numbers`` as in :func:`source_event`."""
    args = (
        t["campaign_contact"].alias("cc"), t["outbound_campaign"].alias("oc"), c("oc.id") == c("cc.campaign_id"),
        [c("oc.company_id").alias("company_id"), c("cc.lead_id").alias("lead_id")], c("oc.name"),
    )
    return joined_max(*args) if numbers is None else joined_max_by_number(*args, numbers)


def newest_widget_per_type(t: Mapping[str, DataFrame], codes: Codes = DEFAULT_CODES) -> DataFrame:
    """R10b-c: per (company, widget type) among the lookup types, the name
    of the widget with the largest id."""
    w = t["widget"]
    return group_argmax_row(
        w, ["company_id", "widget_type"], "id", ["name"], pred=c("widget_type").isin(*codes.lookup_widget_types)
    )


def external_rollup(t: Mapping[str, DataFrame]) -> DataFrame:
    """R10e: per (company, external oid) four independent maxima."""
    return group_maxes(t["external_map"], ["company_id", "oid"], ["ex_id_1", "ex_id_2", "ex_id_3", "ex_source"])


def source_star(t: Mapping[str, DataFrame], codes: Codes = DEFAULT_CODES, heavy: Mapping | None = None,
                stage: Stage | None = None) -> DataFrame:
    """Leads passing the source filter (P10) left-joined to the fourteen
    relations the classification reads. Aliases: lead, evt, camp, wtype, ww,
    auth, cuser, contact, referrer, ext, extra, jl, job, jfam, live. With a ``stage``
    that keeps frames, the max names of events and campaigns are found by number."""
    events = campaigns = None
    if stage is not None and stage.mode is not None:
        events, campaigns = ordered_numbers(
            ("event-name", t["event"], c("name")), ("campaign-name", t["outbound_campaign"], c("name")), stage=stage)
    lead = t["lead"].where(source_lead_predicate("name", "status", codes.status_removed))
    same_company = lambda a: c(f"{a}.company_id") == c("lead.company_id")
    steps = [
        JoinStep(t["lead_extra"], "extra", c("lead.id") == c("extra.lead_id")),
        JoinStep(source_event(t, events), "evt", (c("evt.lead_id") == c("lead.id")) & same_company("evt")),
        JoinStep(source_campaign(t, campaigns), "camp", (c("camp.lead_id") == c("lead.id")) & same_company("camp")),
        JoinStep(
            newest_widget_per_type(t, codes), "wtype",
            (c("wtype.widget_type") == widget_type_key(c("lead.source"), c("lead.web_id"), codes))
            & same_company("wtype"),
            # -1 matches no type: as good as NULL
            key=(("widget type", F.nullif(widget_type_key(c("lead.source"), c("lead.web_id"), codes), F.lit(-1))), "widget_type"), fixed=True,
        ),
        JoinStep(t["widget"], "ww", (c("ww.id") == c("lead.web_id")) & same_company("ww"), key=("lead.web_id", "id")),
        JoinStep(t["auth_user"], "auth", c("auth.id") == c("lead.added_by"), key=("lead.added_by", "id")),
        JoinStep(t["company_user"], "cuser", (c("cuser.user_id") == c("lead.added_by")) & same_company("cuser"), key=("lead.added_by", "user_id")),
        JoinStep(t["contact"], "contact", c("cuser.user_id") == c("contact.user_id"), key=(("lead.added_by", c("cuser.user_id")), "user_id")),
        JoinStep(t["employee"], "referrer", (c("referrer.id") == c("lead.referred_by")) & same_company("referrer"), key=("lead.referred_by", "id")),
        JoinStep(external_rollup(t), "ext", (c("ext.oid") == c("lead.long_id")) & same_company("ext")),
        JoinStep(t["job_loc"], "jl", (c("jl.id") == c("lead.job_loc_id")) & (c("jl.is_deleted") == 0), key=("lead.job_loc_id", "id")),
        JoinStep(t["job"], "job", (c("job.job_req_id") == c("extra.job_req_id")) & (c("job.base_id") > 0), key=("extra.job_req_id", "job_req_id")),
        JoinStep(t["job_family"], "jfam", c("job.job_family_id") == c("jfam.id"), key=("job.job_family_id", "id"), fixed=True),
        JoinStep(
            t["live_job"], "live",
            (c("job.id") == c("live.job_id"))
            & (c("job.job_req_id") == c("live.job_req_id"))
            & (c("jl.id") == c("live.job_loc_id")),
            key=("job.job_req_id", "job_req_id"),
        ),
    ]
    return join_chain(lead, "lead", steps, _skew(t, "lead", heavy))


SOURCE_DATA_COLUMNS = (
    "referred_by_name", "referred_by_email", "referred_by_phone", "add_by_name", "add_by_phone", "add_by_email",
    "external_id_1", "external_id_2", "external_id_3", "ex_source", "compsite_slug", "widget_type",
    "external_job_slug", "event_apply_source", "event_source_name",
)


def source_column_lists(codes: Codes = DEFAULT_CODES) -> tuple[list[tuple[str, Column]], list[tuple[str, Column]]]:
    """R11 over the star's aliases, by output name: the filter part (lead_id, source_name,
    apply_source) and the data part (lead_id and 15 source columns)."""
    s = SourceInputs.from_aliases()
    data = [
        ("lead_id", c("lead.id")),
        ("referred_by_name", c("referrer.name")),
        ("referred_by_email", c("referrer.email")),
        ("referred_by_phone", c("referrer.phone_number")),
        ("add_by_name", c("contact.name")),
        ("add_by_phone", c("contact.phone_number")),
        ("add_by_email", c("cuser.job_email")),
        ("external_id_1", c("ext.ex_id_1")),
        ("external_id_2", c("ext.ex_id_2")),
        ("external_id_3", c("ext.ex_id_3")),
        ("ex_source", c("ext.ex_source")),
        ("compsite_slug", c("ww.compsite_slug")),
        ("widget_type", c("ww.widget_type")),
        ("external_job_slug", c("live.external_job_slug")),
        ("event_apply_source", event_apply_source(s, codes)),
        ("event_source_name", event_source_name(s, codes)),
    ]
    filt = [("lead_id", c("lead.id")), ("source_name", source_name(s, codes)), ("apply_source", apply_source(s, codes))]
    return filt, data


def source_columns(star: DataFrame, codes: Codes = DEFAULT_CODES) -> tuple[DataFrame, DataFrame]:
    """The filter part and the data part of :func:`source_column_lists`."""
    filt, data = (star.select(*[x.alias(name) for name, x in part]) for part in source_column_lists(codes))
    return filt, data


# ---------------------------------------------------------------- data-profile steps


def journey_completed(t: Mapping[str, DataFrame]) -> DataFrame:
    """Per lead, the time of its first journey-complete log entry."""
    pred = (c("module") == JOURNEY_MODULE) & (c("action") == JOURNEY_COMPLETE_ACTION)
    first = first_match(t["logging"], "candidate_id", "id", "created_at", pred, value_alias="journey_completed_at")
    return first.withColumnRenamed("candidate_id", "lead_id")


def last_interview(t: Mapping[str, DataFrame]) -> DataFrame:
    """Per lead, the largest interview id."""
    return last_id(t["interview"], "candidate_id", "id", "last_itv_id").withColumnRenamed("candidate_id", "lead_id")


def meeting_totals(t: Mapping[str, DataFrame]) -> DataFrame:
    """Per lead, total duration (NULL as 0) and count of real meetings."""
    pred = (c("external_id") != "") & (c("provider") > 0)
    return sum_count(t["meeting"], "lead_id", "duration", "id", pred, "total_video_duration", "total_video_meetings")


def repeat_profiles(leads: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Candidate profiles with more than one lead, with the profile's
    public id. Inner join to the profile table first, as the original."""
    joined = leads.alias("rl").join(dealt(t["candidate_profile"].alias("cp")), c("cp.id") == c("rl.candidate_profile_id"))
    flat = joined.select(
        c("rl.candidate_profile_id").alias("candidate_profile_id"), c("rl.id").alias("lead_id"),
        c("cp.public_id").alias("public_id"),
    )
    return repeat_entities(flat, "candidate_profile_id", "lead_id", "public_id", 1, "total_app",
                           "multi_apply_profile_id").select("candidate_profile_id", "multi_apply_profile_id")


ATTENDEE_COLUMNS = {
    "name": "itv_pre_attendee_names",
    "job_email": "itv_pre_attendee_emails",
    "employee_id": "itv_pre_attendee_employee_ids",
    "phone_number": "itv_pre_attendee_phones",
    "role": "itv_roles",
    "acl_role_name": "itv_acl_role_names",
    "user_id": "itv_pre_attendee_user_ids",
}


def attendee_sets(t: Mapping[str, DataFrame]) -> DataFrame:
    """Per (company, candidate) the sorted distinct attendee names,
    emails, employee ids, phones, roles, role names and user ids."""
    steps = [
        JoinStep(
            t["company_user"], "cu",
            (c("pa.user_id") == c("cu.user_id")) & (c("pa.company_id") == c("cu.company_id")), "inner",
        ),
        JoinStep(t["contact"], "ct", c("cu.user_id") == c("ct.user_id"), "inner"),
        JoinStep(
            t["acl_role"], "acl",
            (c("acl.id") == c("cu.acl_role_id")) & (c("acl.company_id") == c("cu.company_id")), fixed=True,
        ),
    ]
    flat = join_chain(t["pre_attendee"], "pa", steps).select(
        c("pa.company_id").alias("company_id"), c("pa.candidate_id").alias("candidate_id"),
        c("ct.name").alias("name"), c("cu.job_email").alias("job_email"), c("cu.employee_id").alias("employee_id"),
        c("ct.phone_number").alias("phone_number"), c("cu.role").alias("role"),
        c("acl.name").alias("acl_role_name"), c("pa.user_id").alias("user_id"),
    )
    sets = set_concat(flat, ["company_id", "candidate_id"], ATTENDEE_COLUMNS)
    return sets.select(*ATTENDEE_COLUMNS.values(), c("candidate_id").alias("lead_id"))


def candidate_language(t: Mapping[str, DataFrame], heavy: Mapping | None = None) -> DataFrame:
    """Detected language name, else language name, else the codes."""
    lang = t["language"]
    joined, value = lookup_fallback(
        t["lead"], "lead", [("detect_language_code", lang, "code", "name"), ("language_code", lang, "code", "name")],
        None if heavy is None else Skew(["lead.id", "lead.company_id"], heavy),
    )
    return joined.select(c("lead.id").alias("lead_id"), value.alias("candidate_language"))


# ---------------------------------------------------------------- whole build


# Tables whose rows belong to exactly one lead, by the column naming it. In a
# changed-id build they are cut to the changed leads before any aggregation:
# every per-lead result depends only on that lead's rows, so the profiles of
# the changed leads are unchanged while the work shrinks to the change set.
LEAD_KEYED = {
    "lead": "id",
    "lead_extra": "lead_id",
    "event_itv_lead": "lead_id",
    "previous_application": "application_id",
    "applied_job": "lead_id",
    "recorded_candidate": "lead_id",
    "logging": "candidate_id",
    "interview": "candidate_id",
    "meeting": "lead_id",
    "event_candidate": "lead_id",
    "campaign_contact": "lead_id",
    "pre_attendee": "candidate_id",
}


def _restrict_lead_keyed(t: dict[str, DataFrame], changed_ids: DataFrame, stage: Stage) -> dict[str, DataFrame]:
    """The lead-keyed tables cut to the change set. With a stage that keeps frames the set is found once, scans skip
    row groups that hold none of it, and a set of more than ``PUSHED_IDS`` is not broadcast."""
    ids, cover, push = id_set(changed_ids), None, stage.mode is not None
    if push:
        (ids,) = stage.keep(("ids", ids))
        cover = id_cover(ids)
        if ids.limit(PUSHED_IDS + 1).count() > PUSHED_IDS:
            ids = dealt(ids)
    out = dict(t)
    for name, key in LEAD_KEYED.items():
        if name in out:
            rows = out[name] if cover is None else out[name].where(cover(key))
            out[name] = restrict_to(rows, ids, key, "id")
    # messages belong to a lead through their recorded-interview parent
    if "recorded_message" in out and "recorded_candidate" in out:
        parents = out["recorded_candidate"].select("id")
        parents = dealt(parents) if push else parents
        out["recorded_message"] = restrict_to(out["recorded_message"], parents, "recorded_itv_candidate_id", "id")
    return out


@dataclass
class Profiles:
    """Both profiles with equal rows counted (column ``COPIES``); ``filter`` and ``data`` hold each row as often as that."""

    counted_filter: DataFrame
    counted_data: DataFrame
    stage: Stage

    @property
    def filter(self) -> DataFrame:
        return repeat_rows(self.counted_filter, COPIES)

    @property
    def data(self) -> DataFrame:
        return repeat_rows(self.counted_data, COPIES)

    @property
    def counted(self) -> dict[str, DataFrame]:
        """The counted profiles by their published names."""
        return dict(zip(PROFILES, (self.counted_filter, self.counted_data)))

    def release(self) -> None:
        """Drop kept intermediates once both outputs are written."""
        self.stage.release()


def build_profiles(
    tables: Mapping[str, DataFrame],
    codes: Codes = DEFAULT_CODES,
    changed_ids: DataFrame | None = None,
    materialize_mode: str | None = None,
    since: str = APPLICATION_PERIOD_START,
) -> Profiles:
    """Build both profile tables from the role frames in ``tables``.

    With ``changed_ids`` (a one-column frame of lead ids) only those leads
    are rebuilt (R17); every other table is read in full. The repeat-profile
    count (R12) then uses the *full* lead table limited to the profiles of
    the changed leads, so an incremental row equals the full-run row.

    Four frames feed more than one place and are kept, beside the numbers of names, by ``materialize_mode``
    (see :class:`Stage`): the base columns of both profiles, the picked applications,
    the application detail and the source columns. The two steps that join a
    profile to something derived from itself (R12's repeats, R16's attribute) take
    the number of a lead's rows from those frames, so neither profile is computed twice. As those steps repeat each row
    as often as its lead has rows, a profile grows with the square of that number: equal rows stay one with a count through
    all joins, and are repeated by whoever reads the profile. ``Profiles.release`` drops what was kept."""
    t = dict(tables)
    all_leads = t["lead"]
    stage = Stage(all_leads.sparkSession, materialize_mode)
    if changed_ids is not None:
        t = _restrict_lead_keyed(t, changed_ids, stage)
        # S3: the restricted lead table feeds six branches of the build
        (t["lead"],) = stage.keep(("lead", t["lead"]))

    # a build that keeps frames runs jobs anyhow: one more pass over two tables finds the heavy keys
    heavy = measure_skew(t) if materialize_mode else None
    base, star = gathered_base(t, heavy), source_star(t, codes, heavy, stage)
    flat = [*project_filter_columns(codes), *(x for x in project_data_columns() if x[0] not in ("lead_id", "company_id"))]
    flat = [x for x in flat if x[0] not in ("area_id", "job_location_id")]
    src_filter, src_data = (dict(x) for x in source_column_lists(codes))
    base, star, picked = stage.keep(
        ("base", base.select(*[x.alias(name) for name, x in flat], _AREAS, _PLACES, _TIMES, _ROWS)),
        ("sources", star.select(*[x.alias(name) for name, x in {**src_filter, **src_data}.items()])),
        ("applications", picked_applications(t, since)),
    )
    (detail,) = stage.keep(("detail", application_detail(t, codes, since, picked.where("in_period"), heavy)))
    latest = picked.where("is_latest").select(c("id").alias("latest_apply_job_id"), "lead_id")

    filt = base.select(*[name for name, _ in project_filter_columns(codes) if name != "area_id"], _AREAS, _TIMES)
    for part in (latest, recorded_counts(t), detail, star.select(*src_filter)):
        filt = filt.join(dealt(part), "lead_id", "left")

    # how often the left joins repeat a base row of a lead
    times = base.where(c("lead_id").isNotNull()).groupBy("lead_id", "candidate_profile_id").agg(F.sum(_ROWS).alias("copies"))
    for i, part in enumerate((latest, detail, star)):
        times = times.join(dealt(rows_per_key(part, "lead_id", f"__n{i}")), "lead_id", "left")
    by_latest, by_detail, by_source = (F.coalesce(f"__n{i}", F.lit(1)) for i in range(3))

    rows = times.groupBy("lead_id").agg(F.sum(c("copies") * by_detail * by_source).alias("copies"))
    values = attribute_values(
        rows.join(dealt(latest), "lead_id", "left"), t["applied_job_extra"], "lead_id", "latest_apply_job_id", "applied_job_id",
        "system_attribute_key_name", CUSTOM_ORG_KEY, "custom_field_value", "job_applied_extra_org",
    )
    filt = filt.join(dealt(values.withColumnRenamed("copies", COPIES)), "lead_id", "left")

    data = base.select(*[name for name, _ in project_data_columns() if name != "job_location_id"], _PLACES)
    repeat_leads = all_leads
    if changed_ids is not None:
        profiles = t["lead"].select("candidate_profile_id")
        repeat_leads = restrict_to(all_leads, dealt(profiles) if materialize_mode else profiles, "candidate_profile_id")
    before_sources = times.select("lead_id", "candidate_profile_id", (c("copies") * by_latest * by_detail).alias(COPIES))
    repeats = before_sources.join(dealt(repeat_profiles(repeat_leads, t)), "candidate_profile_id", "left")
    repeats = repeats.select("lead_id", "multi_apply_profile_id", COPIES)
    sources, language = star.select(*src_data), candidate_language(t, heavy)
    for part in (journey_completed(t), last_interview(t), meeting_totals(t), repeats, attendee_sets(t), sources, language):
        data = data.join(dealt(part), "lead_id", "left")
    return Profiles(filter_rows(filt), data_rows(data), stage)


def write_profiles(
    tables: Mapping[str, DataFrame],
    filter_path: str,
    data_path: str,
    codes: Codes = DEFAULT_CODES,
    changed_ids: DataFrame | None = None,
    materialize_mode: str = "table",
    since: str = APPLICATION_PERIOD_START,
) -> bool:
    """Build and write both profiles (S5, S6). Returns False without writing
    when a changed-id run has no leads (S4).

    A full run replaces what stands at the paths. A changed-id run is a delta:
    it must go to new paths (anything there is an error, so that it can't
    replace a full profile); ``merge_profile`` puts it into the full one.
    ``entiprof.sources.snapshots`` publishes either, with one commit for both profiles."""
    if changed_ids is not None and not has_rows(restrict_to(tables["lead"], changed_ids, "id")):
        return False
    prof = build_profiles(tables, codes, changed_ids, materialize_mode, since=since)
    try:
        mode = "overwrite" if changed_ids is None else "errorifexists"
        write_tables([(prof.filter, filter_path), (prof.data, data_path)], mode)
    finally:
        prof.release()
    return True


PROFILES = ("filter_profile", "data_profile")


def publish_profiles(
    tables: Mapping[str, DataFrame],
    target: Snapshots,
    codes: Codes = DEFAULT_CODES,
    changed_ids: DataFrame | None = None,
    since: str = APPLICATION_PERIOD_START,
    materialize_mode: str = "table",
    writer: str | None = None,
    step: int = 0,
) -> bool:
    """Build both profiles and publish them in one commit.

    A full run replaces what is published; a changed-id run replaces the rows of its
    ids, those of leads that are gone included. Returns False, with nothing
    published, for an empty change set (S4)."""
    ids = None if changed_ids is None else id_set(changed_ids)
    if ids is not None and not has_rows(ids):
        return False
    prof = build_profiles(tables, codes, ids, materialize_mode, since=since)
    try:
        if ids is None:
            target.publish_full(prof.counted)
        else:
            target.publish_change(prof.counted, ids, writer, step)
    finally:
        prof.release()
    return True


def merge_profile(full: DataFrame, delta: DataFrame, changed_ids: DataFrame, key: str = "lead_id") -> DataFrame:
    """The full profile with the changed leads' rows replaced by the delta's;
    leads that are in ``changed_ids`` but no longer in the delta go. To be
    written to a new folder, not over ``full``."""
    ids = id_set(changed_ids)
    kept = full.join(ids, full[key] == ids["id"], "left_anti")
    return kept.unionByName(delta)
