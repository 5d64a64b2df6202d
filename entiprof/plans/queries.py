"""Query keys on the driver's test tables (one per operator family).

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables; ``entiprof.plans.oracle`` holds the equivalent SQL. Computed
columns carry the same alias on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiprof.functions.predicates import json_equals, map_lookup, valid_name_flag
from entiprof.job import ROLE_TABLES
from entiprof.operators.aggregates import (
    conditional_span_joined,
    group_maxes,
    repeat_entities,
    set_concat,
    sum_count,
)
from entiprof.operators.latest import (
    LatestTarget,
    first_match,
    group_argmax_row,
    last_id,
    latest_preferred,
    latest_preferred_since,
    latest_rows,
)
from entiprof.operators.lookups import JoinStep, attribute_lookup, join_chain, lookup_fallback
from entiprof.operators.ordered import set_concat_parts
from entiprof.operators.ranks import joined_max_by_number, ordered_numbers
from entiprof.plans import assemble
from entiprof.plans.roles import role_frames
from entiprof.session import ensure_checkpoint_dir
from entiprof.sources.layout import open_inputs, store_inputs
from entiprof.sources.sinks import Stage, write_table
from entiprof.sources.snapshots import Snapshots
from entiprof.sources.tables import load_tables, restrict_to

c = F.col

# Parameters of the queries on the driver tables.
ROLE_PERIOD_START = "2000-01-01"  # role applications span 1995-2001
LINEITEM_PERIOD_START = "1997-07-01"
CHANGED_SINCE = "2001-06-01"
SEGMENT_CODES = {"BUILDING": "B", "MACHINERY": "M", "HOUSEHOLD": "H", "FURNITURE": "F"}


def _t(spark: SparkSession, sf_dir: str):
    return load_tables(spark, sf_dir)


def _roles(spark: SparkSession, sf_dir: str):
    return role_frames(_t(spark, sf_dir))


def _profiles(spark: SparkSession, sf_dir: str) -> assemble.Profiles:
    """Both profile tables come from one build, as in a job that writes
    both, with the frames that feed both kept as tables; q30 and q31 are its two outputs."""
    return assemble.build_profiles(_roles(spark, sf_dir), since=ROLE_PERIOD_START, materialize_mode="table")


def _source_parts(spark: SparkSession, sf_dir: str):
    return assemble.source_columns(assemble.source_star(_roles(spark, sf_dir)))


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.application_detail(_roles(spark, sf_dir), since=ROLE_PERIOD_START)


# ------------------------------------------------------------ plain-table queries


def q01_wide_left_join(spark, sf_dir):
    t = _t(spark, sf_dir)
    steps = [
        JoinStep(t["nation"], "n", c("cu.c_nationkey") == c("n.n_nationkey")),
        JoinStep(t["region"], "r", c("n.n_regionkey") == c("r.r_regionkey")),
        JoinStep(t["orders"], "o", (c("o.o_custkey") == c("cu.c_custkey")) & (c("o.o_orderstatus") == "F")),
        JoinStep(t["lineitem"], "li", (c("li.l_orderkey") == c("o.o_orderkey")) & (c("li.l_returnflag") == "N")),
    ]
    return join_chain(t["customer"], "cu", steps).select(
        c("cu.c_custkey").alias("c_custkey"), c("cu.c_name").alias("c_name"), c("n.n_name").alias("n_name"),
        c("r.r_name").alias("r_name"), c("o.o_orderkey").alias("o_orderkey"), c("o.o_orderdate").alias("o_orderdate"),
        c("li.l_linenumber").alias("l_linenumber"), c("li.l_partkey").alias("l_partkey"),
        c("li.l_quantity").alias("l_quantity"),
    )


def q02_valid_flag(spark, sf_dir):
    docs = _t(spark, sf_dir)["documents"]
    return docs.select("doc_id", valid_name_flag(c("text"), c("source"), "src0").alias("is_valid_name_and_status"))


def q03_latest_preferred(spark, sf_dir):
    li = _t(spark, sf_dir)["lineitem"]
    rows = latest_preferred(li, "l_orderkey", "l_shipdate", c("l_returnflag") == "N")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")


def q04_latest_preferred_since(spark, sf_dir):
    li = _t(spark, sf_dir)["lineitem"]
    rows = latest_preferred_since(
        li, "l_orderkey", "l_shipdate", c("l_returnflag") == "N", c("l_returnflag") == "R", LINEITEM_PERIOD_START
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")


def q05_conditional_span(spark, sf_dir):
    t = _t(spark, sf_dir)
    return conditional_span_joined(
        t["orders"], "o_orderkey", "o_custkey", t["lineitem"], "l_orderkey", c("l_returnflag") == "R",
        "l_shipdate", parent_pred=c("o_orderstatus") == "F",
    )


def q06_first_match(spark, sf_dir):
    ev = _t(spark, sf_dir)["events"]
    return first_match(ev, "user_id", "event_id", "ts", c("event_type") == "signup", value_alias="first_ts")


def q07_last_id(spark, sf_dir):
    return last_id(_t(spark, sf_dir)["events"], "user_id", "event_id", "last_event_id")


def q08_sum_count(spark, sf_dir):
    ev = _t(spark, sf_dir)["events"].withColumn("amount", c("value").cast("decimal(18,2)"))
    return sum_count(ev, "user_id", "amount", "event_id", (c("props") != "") & (c("value") > 1), "total_value", "n_events")


def q09_max_name(spark, sf_dir):
    t = _t(spark, sf_dir)
    (names,) = ordered_numbers(("part-name", t["part"], c("p_name")), stage=Stage(spark, "table"))
    return joined_max_by_number(
        t["lineitem"].alias("li"), t["part"].alias("p"), c("p.p_partkey") == c("li.l_partkey"),
        [c("li.l_suppkey").alias("l_suppkey"), c("li.l_orderkey").alias("l_orderkey")], c("p.p_name"), names, "max_name",
    )


def q10_group_argmax(spark, sf_dir):
    part = _t(spark, sf_dir)["part"]
    return group_argmax_row(
        part, ["p_brand", "p_type"], "p_partkey", ["p_name"], pred=c("p_type").isin("PROMO", "SMALL", "LARGE")
    )


def q11_group_maxes(spark, sf_dir):
    orders = _t(spark, sf_dir)["orders"]
    return group_maxes(
        orders, ["o_custkey", "o_orderstatus"],
        {"o_orderkey": "max_orderkey", "o_totalprice": "max_totalprice", "o_orderdate": "max_orderdate",
         "o_orderpriority": "max_orderpriority"},
    )


def q12_case_key_join(spark, sf_dir):
    t = _t(spark, sf_dir)
    key = (
        F.when((c("cu.c_mktsegment") == "BUILDING") & (c("cu.c_custkey") % 7 == 0), F.lit(0))
        .when(c("cu.c_mktsegment") == "MACHINERY", F.lit(1))
        .when(c("cu.c_mktsegment") == "HOUSEHOLD", F.lit(2))
        .otherwise(F.lit(-1))
    )
    j = t["customer"].alias("cu").join(t["region"].alias("r"), c("r.r_regionkey") == key, "left")
    return j.select(c("cu.c_custkey").alias("c_custkey"), c("cu.c_mktsegment").alias("c_mktsegment"),
                    c("r.r_name").alias("r_name"))


def q19_repeat_entities(spark, sf_dir):
    t = _t(spark, sf_dir)
    j = t["orders"].join(t["customer"], c("c_custkey") == c("o_custkey"), "inner")
    return repeat_entities(j, "o_custkey", "o_orderkey", "c_name", 10, "total_orders", "min_name")


def q21_json_flag(spark, sf_dir):
    ev = _t(spark, sf_dir)["events"]
    return ev.select("event_id", json_equals(c("props"), "$.k", "69").alias("k_is_69"))


def q22_set_concat(spark, sf_dir):
    ev = _t(spark, sf_dir)["events"].withColumn("k", F.get_json_object("props", "$.k"))
    return set_concat(ev, "user_id", {"event_type": "event_types", "k": "k_values"})


def q23_lookup_fallback(spark, sf_dir):
    t = _t(spark, sf_dir)
    cust = t["customer"].select(
        "c_custkey",
        F.when(c("c_custkey") % 11 == 0, F.lit(None)).otherwise(c("c_nationkey") * 2).alias("code1"),
        (c("c_nationkey") % 7).alias("code2"),
    )
    joined, value = lookup_fallback(
        cust, "cu", [("code1", t["nation"], "n_nationkey", "n_name"), ("code2", t["region"], "r_regionkey", "r_name")]
    )
    return joined.select(c("cu.c_custkey").alias("c_custkey"), value.alias("place"))


def _orders_latest(t):
    orders = t["orders"].withColumn("o_month", F.date_trunc("month", c("o_orderdate")))
    return latest_preferred(orders, "o_custkey", "o_month", c("o_orderstatus") == "F").select(
        "o_custkey", "o_orderkey", "o_orderstatus"
    )


def q24_attribute_lookup(spark, sf_dir):
    t = _t(spark, sf_dir)
    j = t["orders"].alias("o").join(
        t["lineitem"].alias("li"), (c("li.l_orderkey") == c("o.o_orderkey")) & (c("li.l_returnflag") == "R"), "left"
    )
    return j.select(c("o.o_custkey").alias("o_custkey"), c("o.o_orderkey").alias("o_orderkey"),
                    c("li.l_linenumber").alias("returned_line"))


def q25_attribute_rejoin(spark, sf_dir):
    t = _t(spark, sf_dir)
    prof = _orders_latest(t)
    return attribute_lookup(prof, t["lineitem"], "o_custkey", "o_orderkey", "l_orderkey", "l_returnflag", "R",
                            "l_linenumber", "returned_line")


def q26_changed_ids(spark, sf_dir):
    orders = _t(spark, sf_dir)["orders"]
    changed = orders.where(c("o_orderdate") >= F.lit(CHANGED_SINCE)).select(c("o_custkey").alias("id"))
    return restrict_to(orders, changed, "o_custkey", "id").select("o_orderkey", "o_custkey", "o_orderstatus")


def q27_map_lookup(spark, sf_dir):
    cust = _t(spark, sf_dir)["customer"]
    return cust.select("c_custkey", map_lookup(SEGMENT_CODES, c("c_mktsegment")).alias("segment_code"))


def q28_max_name_campaign(spark, sf_dir):
    t = _t(spark, sf_dir)
    (names,) = ordered_numbers(("priority", t["orders"], c("o_orderpriority")), stage=Stage(spark, "table"))
    return joined_max_by_number(
        t["customer"].alias("cu"), t["orders"].alias("o"), c("cu.c_custkey") == c("o.o_custkey"),
        [c("cu.c_nationkey").alias("c_nationkey"), c("o.o_custkey").alias("o_custkey")], c("o.o_orderpriority"), names,
        "max_priority",
    )


def q29_write_read(spark, sf_dir):
    """Sink round trip: q07 written as parquet under the session's shared
    checkpoint folder and read back."""
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/entiprof-write-read-{uuid.uuid4().hex}"
    write_table(q07_last_id(spark, sf_dir), out)
    return spark.read.parquet(out)


# ------------------------------------------------------------ role queries


def q13_source_star(spark, sf_dir):
    star = assemble.source_star(_roles(spark, sf_dir), stage=Stage(spark, "table"))
    return star.select(
        c("lead.id").alias("lead_id"), c("evt.name").alias("event_name"), c("camp.name").alias("campaign_name"),
        c("wtype.name").alias("type_widget_name"), c("ww.id").alias("web_widget_id"),
        c("auth.name").alias("auth_name"), c("cuser.user_id").alias("company_user_id"),
        c("contact.name").alias("contact_name"), c("referrer.name").alias("referrer_name"),
        c("ext.ex_source").alias("ex_source"), c("extra.id").alias("extra_id"), c("jl.id").alias("job_loc_id"),
        c("job.id").alias("job_id"), c("jfam.id").alias("job_family_id"), c("live.id").alias("live_job_id"),
    )


def _source_part(spark, sf_dir, part: int, column: str):
    return _source_parts(spark, sf_dir)[part].select("lead_id", column)


def q14_source_name(spark, sf_dir):
    return _source_part(spark, sf_dir, 0, "source_name")


def q15_event_source_name(spark, sf_dir):
    return _source_part(spark, sf_dir, 1, "event_source_name")


def q16_apply_source(spark, sf_dir):
    return _source_part(spark, sf_dir, 0, "apply_source")


def q17_event_apply_source(spark, sf_dir):
    return _source_part(spark, sf_dir, 1, "event_apply_source")


def q18_folder(spark, sf_dir):
    return _detail(spark, sf_dir).select("lead_id", "cem_folder")


def q20_application_detail(spark, sf_dir):
    return _detail(spark, sf_dir)


def q30_filter_profile(spark, sf_dir):
    return _profiles(spark, sf_dir).filter


def q31_data_profile(spark, sf_dir):
    return _profiles(spark, sf_dir).data


def changed_lead_ids(tables) -> DataFrame:
    """Leads with an order on or after ``CHANGED_SINCE``: the change set of
    the incremental query, derived from the data."""
    return tables["orders"].where(c("o_orderdate") >= F.lit(CHANGED_SINCE)).select(c("o_custkey").alias("id"))


def q32_incremental_profile(spark, sf_dir):
    t = _t(spark, sf_dir)
    return assemble.build_profiles(
        _roles(spark, sf_dir), since=ROLE_PERIOD_START, changed_ids=changed_lead_ids(t), materialize_mode="table"
    ).data



def q34_attendee_sets(spark, sf_dir):
    return assemble.attendee_sets(_roles(spark, sf_dir))


def q35_candidate_language(spark, sf_dir):
    return assemble.candidate_language(_roles(spark, sf_dir))


def q36_repeat_profiles(spark, sf_dir):
    roles = _roles(spark, sf_dir)
    return assemble.repeat_profiles(roles["lead"], roles)


def q37_recorded_counts(spark, sf_dir):
    return assemble.recorded_counts(_roles(spark, sf_dir))


def q38_journey_completed(spark, sf_dir):
    return assemble.journey_completed(_roles(spark, sf_dir))


def q39_last_interview(spark, sf_dir):
    return assemble.last_interview(_roles(spark, sf_dir))


def q40_meeting_totals(spark, sf_dir):
    return assemble.meeting_totals(_roles(spark, sf_dir))


def q41_supplier_sets(spark, sf_dir):
    """Set concatenation over a join chain: suppliers with their nation and
    (for the first three regions) region, per region key. A region's set grows with the
    table, so its text is made in chunks; texts past the limit of a row would give more rows."""
    t = _t(spark, sf_dir)
    steps = [
        JoinStep(t["nation"], "n", c("s.s_nationkey") == c("n.n_nationkey"), "inner"),
        JoinStep(t["region"], "r", (c("n.n_regionkey") == c("r.r_regionkey")) & (c("r.r_regionkey") < 3)),
    ]
    flat = join_chain(t["supplier"], "s", steps).select(
        c("n.n_regionkey").alias("n_regionkey"), c("s.s_suppkey").alias("s_suppkey"),
        c("n.n_name").alias("n_name"), c("r.r_name").alias("r_name"),
    )
    names = {"s_suppkey": "supplier_keys", "n_name": "nation_names", "r_name": "region_names"}
    return set_concat_parts(flat, "n_regionkey", names, Stage(spark, "table")).drop("part")


def run_stream_refresh(spark, sf_dir, files_per_trigger: int | None = None) -> DataFrame:
    """The changed-id build as a stream over change-id files derived from the
    orders (two overlapping files), read back as the newest epoch per lead."""
    from entiprof.streaming.incremental import read_latest, start_refresh

    t = _t(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/entiprof-stream-{uuid.uuid4().hex}"
    changed = t["orders"].where(c("o_orderdate") >= F.lit(CHANGED_SINCE))
    changed.where(c("o_orderstatus") == "F").select(c("o_custkey").alias("id")) \
        .write.parquet(f"{root}/ids/part=a")
    changed.where(c("o_orderstatus") != "F").select(c("o_custkey").alias("id")) \
        .write.parquet(f"{root}/ids/part=b")
    query = start_refresh(
        spark, _roles(spark, sf_dir), f"{root}/ids/*", f"{root}/filter", f"{root}/data",
        checkpoint=f"{root}/checkpoint", since=ROLE_PERIOD_START, available_now=True,
        max_files_per_trigger=files_per_trigger,
    )
    query.awaitTermination()
    return read_latest(spark, f"{root}/data")


def q33_stream_refresh(spark, sf_dir):
    """Streaming form of q32: all pending change files in one micro-batch
    (the multi-batch case, one file per trigger, is covered by the tests)."""
    return run_stream_refresh(spark, sf_dir)


def _published(spark, sf_dir):
    """Published profiles after a full run over an earlier state of the leads, a
    changed-id run over the present one, and a run with an empty change set."""
    roles = _roles(spark, sf_dir)
    renamed = c("id") % 3 == 0
    before = {**roles, "lead": roles["lead"].withColumns({
        "name": F.when(renamed, F.lit("test before")).otherwise(c("name")),
        "added_by": F.when(renamed, c("added_by") + 2).otherwise(c("added_by")),
    })}
    target = Snapshots(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/entiprof-published-{uuid.uuid4().hex}")
    assemble.publish_profiles(before, target, since=ROLE_PERIOD_START)
    changed = roles["lead"].where(renamed).select("id")
    assemble.publish_profiles(roles, target, changed_ids=changed, since=ROLE_PERIOD_START)
    assemble.publish_profiles(roles, target, changed_ids=changed.where(F.lit(False)), since=ROLE_PERIOD_START)
    return target


def q42_published_filter(spark, sf_dir):
    """The published filter profile equals a full run over the present tables."""
    return _published(spark, sf_dir).read("filter_profile")


def q43_published_data(spark, sf_dir):
    return _published(spark, sf_dir).read("data_profile")


def q44_latest_text_times(spark, sf_dir):
    """q03 over times that are stored as text."""
    lines = _t(spark, sf_dir)["lineitem"].withColumn("l_shipdate", c("l_shipdate").cast("string"))
    rows = latest_preferred(lines, "l_orderkey", "l_shipdate", c("l_returnflag") == "N")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
                       c("l_shipdate").cast("timestamp_ntz").alias("l_shipdate"))


def q45_latest_rows(spark, sf_dir):
    """Both choices of latest lines (q03's and q04's) with one aggregation and one join back."""
    valid, invalid = c("l_returnflag") == "N", c("l_returnflag") == "R"
    targets = [LatestTarget("is_latest", valid), LatestTarget("in_period", valid, invalid, LINEITEM_PERIOD_START)]
    rows = latest_rows(_t(spark, sf_dir)["lineitem"], "l_orderkey", "l_shipdate", targets)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate", "is_latest", "in_period")


def q46_stored_inputs(spark, sf_dir):
    """q32 from inputs that are stored by lead: bucketed scans, cut to the row groups that may hold changed leads."""
    t, roles = _t(spark, sf_dir), _roles(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/entiprof-inputs-{uuid.uuid4().hex}"
    store_inputs({name: roles[name] for name in ROLE_TABLES}, root, assemble.LEAD_KEYED, buckets=8)
    return assemble.build_profiles(
        open_inputs(spark, root), since=ROLE_PERIOD_START, changed_ids=changed_lead_ids(t), materialize_mode="table"
    ).data


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items()) if name[:1] == "q" and name[1:3].isdigit() and callable(fn)
}

