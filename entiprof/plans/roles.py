"""Role views: the profile job's 35 input tables, derived from the driver's
test tables by deterministic projections.

Each role is one SQL projection of one driver table, written in the subset of
SQL that Spark and DuckDB read alike (CASE, %, ||, CAST, date_trunc). Spark
builds it with ``selectExpr``; the oracle inlines the same text as a CTE, so
both engines see identical inputs. Every row of the source table is kept:
membership and fan-out are shaped by CASE expressions (ids that point nowhere
are negative), never by sampling, so the work grows with the tables.

``k`` below stands for the customer key.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

K = "c_custkey"


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _ts(year_expr: str, rest: str) -> str:
    """Timestamp from a year expression and a fixed '-MM-DD hh:mm:ss' tail."""
    return f"CAST({_s(year_expr)} || '{rest}' AS TIMESTAMP)"


def _nowhere(expr: str, keep: str) -> str:
    """``expr`` where ``keep`` holds, else a negative id that matches nothing."""
    return f"CASE WHEN {keep} THEN {expr} ELSE -1 - {expr} END"


@dataclass(frozen=True)
class Role:
    name: str
    source: str
    columns: tuple[tuple[str, str], ...]
    where: str | None = None
    union_where: str | None = None  # optional second copy of the rows (fan-out 2)
    union_columns: tuple[tuple[str, str], ...] | None = None

    def _select_sql(self, columns, where) -> str:
        cols = ", ".join(f"{expr} AS {name}" for name, expr in columns)
        tail = f" WHERE {where}" if where else ""
        return f"SELECT {cols} FROM {self.source}{tail}"

    def sql(self) -> str:
        text = self._select_sql(self.columns, self.where)
        if self.union_where:
            text += " UNION ALL " + self._select_sql(self.union_columns or self.columns, self.union_where)
        return text

    def frame(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        def part(columns, where):
            df = tables[self.source]
            if where:
                df = df.where(where)
            return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns])

        out = part(self.columns, self.where)
        if self.union_where:
            out = out.unionByName(part(self.union_columns or self.columns, self.union_where))
        return out


def _lead_name() -> str:
    return (
        f"CASE {K} % 23 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Test ' || c_name "
        f"WHEN 3 THEN 'an unknown' WHEN 4 THEN 'Unknown' ELSE c_name END"
    )


def _phone(mod: int, prefix: str) -> str:
    return f"CASE WHEN {K} % {mod} < 3 THEN '' WHEN {K} % {mod} = 3 THEN NULL ELSE '{prefix}' || {_s(K)} END"


_LANG_CODES = "CASE {m} WHEN 0 THEN 'af' WHEN 1 THEN 'am' WHEN 2 THEN 'as' WHEN 3 THEN 'eu' WHEN 4 THEN 'mi' " \
              "WHEN 5 THEN 'zz' ELSE NULL END"

ROLES: dict[str, Role] = {}


def _add(role: Role) -> None:
    ROLES[role.name] = role


_add(Role("lead", "customer", (
    ("id", K),
    ("company_id", "c_nationkey"),
    ("long_id", K),
    ("conversation_id", f"{K} * 10 + 1"),
    ("company_group_id", "CAST(c_nationkey % 5 AS INT)"),
    ("candidate_profile_id", f"CASE WHEN {K} % 4 < 2 THEN {K} - {K} % 4 ELSE {K} END"),
    ("apply_type", f"CAST(CASE WHEN {K} % 5 = 0 THEN 1 ELSE 0 END AS INT)"),
    ("created_at", _ts(f"2000 + {K} % 20", "-01-15 08:30:00")),
    ("updated_at", _ts(f"2001 + {K} % 20", "-03-01 12:00:00")),
    ("interviewer_ids", _s(f"{K} % 97")),
    ("is_valid", f"CAST({K} % 2 AS INT)"),
    ("external_source_id", f"'ext-' || {_s(K)}"),
    ("referred_by", f"CASE {K} % 6 WHEN 0 THEN {K} + 1 WHEN 1 THEN 999999999 WHEN 2 THEN NULL ELSE 0 END"),
    ("added_by", f"CASE WHEN {K} % 4 = 0 THEN 0 ELSE {K} END"),
    ("name", _lead_name()),
    ("phone_number", f"'+1' || {_s(K)}"),
    ("email", f"'lead' || {_s(K)} || '@example.com'"),
    ("status", f"CAST(CASE WHEN {K} % 29 = 0 THEN 9 WHEN {K} % 29 = 1 THEN NULL ELSE 1 END AS INT)"),
    ("ip_addr", f"'10.0.0.' || {_s(f'{K} % 250')}"),
    ("start_kw", f"'kw' || {_s(K)}"),
    ("source", f"CAST({K} % 13 AS INT)"),
    ("tz_str", "CASE WHEN c_nationkey % 2 = 0 THEN 'UTC' ELSE 'America/Chicago' END"),
    ("job_loc_id", f"{K} % 97"),
    ("web_id", f"CASE WHEN {K} % 7 = 0 THEN 0 ELSE c_nationkey + 25 * ({K} % 8) END"),
    ("completed", f"CAST({K} % 3 AS INT)"),
    ("detect_language_code", _LANG_CODES.format(m=f"{K} % 9")),
    ("language_code", _LANG_CODES.format(m=f"{K} % 7")),
    ("itv_requested_at", _ts(f"2010 + {K} % 10", "-06-01 09:00:00")),
    ("responsed", f"CAST({K} % 2 AS INT)"),
    ("recent_ai_phone_number", _phone(9, "+2")),
    ("past_interviewer_ids", _s(f"{K} % 31")),
    ("opt_in_status", f"CAST({K} % 3 AS INT)"),
    ("outbound_accepted", f"CAST({K} % 2 AS INT)"),
    ("unsubscribed", f"CAST(({K} + 1) % 2 AS INT)"),
    ("last_contacted_at_timestamp", f"1600000000 + {K} * 60"),
    ("primary_contact_method", "CASE WHEN c_mktsegment = 'BUILDING' THEN 'email' ELSE 'sms' END"),
    ("referrer", "c_mktsegment"),
    ("location_number", _phone(8, "+1")),
    ("interview_type", f"CASE WHEN {K} % 10 = 9 THEN 'n/a' ELSE {_s(f'{K} % 4')} END"),
    ("schedule_by", f"CAST({K} % 3 AS INT)"),
    ("interview_jobloc_id", f"{K} % 50"),
)))

_add(Role("lead_extra", "customer", (
    ("id", f"{K} + 100000000"),
    ("lead_id", _nowhere(K, f"{K} % 11 <> 0")),
    ("journey_stage_id", f"CASE WHEN {K} % 4 = 0 THEN NULL ELSE c_nationkey END"),
    ("journey_status_id", f"CAST({K} % 5 AS INT)"),
    ("job_req_id", f"CASE WHEN {K} % 17 = 0 THEN '' ELSE 'REQ' || {_s(K)} END"),
    ("application_id", f"{K} * 3 + 7"),
    ("job_title", f"CASE WHEN {K} % 5 = 0 THEN '' ELSE 'extra title ' || {_s(K)} END"),
    ("external_info", f"'info ' || {_s(f'{K} % 13')}"),
    ("consent_to_marketing", f"CAST({K} % 2 AS INT)"),
    ("apply_url", f"'https://apply.example/' || {_s(K)}"),
    ("journey_candidate_status", f"CAST({K} % 6 AS INT)"),
    ("itv_scheduling_method", f"CASE WHEN {K} % 12 = 5 THEN 'manual' ELSE {_s(f'{K} % 3')} END"),
)))

_add(Role("candidate_profile", "customer", (
    ("id", _nowhere(K, f"{K} % 13 <> 5")),
    ("public_id", f"'P-' || {_s(K)}"),
    ("phone_number", f"'+3' || {_s(K)}"),
    ("email", f"'person' || {_s(K)} || '@example.org'"),
)))

_add(Role("event_itv_lead", "customer", (
    ("id", f"{K} + 200000000"),
    ("lead_id", _nowhere(K, f"{K} % 3 = 0")),
    ("checked_in", f"CAST({K} % 2 AS INT)"),
    ("status", f"CAST({K} % 4 AS INT)"),
    ("selected_time_at", _ts(f"2015 + {K} % 5", "-02-02 10:00:00")),
    ("requested_at", _ts(f"2014 + {K} % 5", "-02-01 10:00:00")),
)))

_add(Role("journey_stage", "nation", (
    ("id", "n_nationkey"),
    ("company_id", "n_nationkey"),
)))

_add(Role("stage_status", "nation", (
    ("id", "n_regionkey"),
    ("stage_id", "n_nationkey"),
)))

_add(Role("company_area", "supplier", (
    ("id", "s_suppkey"),
    ("job_loc_id", "s_suppkey % 97"),
    ("company_id", "s_nationkey"),
)))

_add(Role("job_loc", "supplier", (
    ("id", "s_suppkey"),
    ("is_deleted", "CAST(CASE WHEN s_suppkey % 9 = 4 THEN 1 ELSE 0 END AS INT)"),
    ("location_id", "s_nationkey * 1000 + s_suppkey"),
)))

_add(Role("previous_application", "customer", (
    ("id", f"{K} + 300000000"),
    ("application_id", _nowhere(K, f"{K} % 5 = 1")),
    ("reapply_type", f"CAST({K} % 3 AS INT)"),
)))

_JOB_REQ = "'REQ' || CAST(CASE WHEN p_partkey % 5 = 1 THEN p_partkey - 1 ELSE p_partkey END AS STRING)"

_add(Role("job", "part", (
    ("id", "p_partkey"),
    ("job_req_id", _JOB_REQ),
    ("base_id", "CASE WHEN p_partkey % 10 = 3 THEN 0 ELSE p_partkey + 1 END"),
    ("company_brand_id", "p_partkey % 40"),
    ("name", "CASE WHEN p_partkey % 6 = 0 THEN '' ELSE p_name END"),
    ("job_family_id", "p_partkey % 30"),
)))

_add(Role("job_location", "part", (
    ("id", "p_partkey + 400000000"),
    ("job_id", "p_partkey"),
    ("company_area_id", "p_partkey % 97"),
)))

_add(Role("company_brand", "supplier", (
    ("id", "s_suppkey"),
    ("status", "CAST(CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 1 END AS INT)"),
)))

_add(Role("live_job", "part", (
    ("id", "p_partkey + 500000000"),
    ("job_id", "p_partkey"),
    ("job_req_id", _JOB_REQ),
    ("job_loc_id", "p_partkey % 97"),
    ("external_job_slug", "'slug-' || CAST(p_partkey AS STRING)"),
)))

_add(Role("logging", "events", (
    ("id", "event_id"),
    ("candidate_id", "user_id"),
    ("module", "CASE WHEN event_type IN ('signup', 'purchase') THEN 'JOURNEY' ELSE 'CHAT' END"),
    ("action", "CASE WHEN event_type IN ('signup', 'view') THEN 'Capture: Capture Complete' ELSE 'Other' END"),
    ("created_at", "ts"),
)))

_add(Role("interview", "events", (
    ("id", "event_id"),
    ("candidate_id", _nowhere("user_id", "event_type = 'view'")),
)))

_add(Role("applied_job", "orders", (
    ("id", "o_orderkey"),
    ("lead_id", _nowhere("o_custkey", "o_custkey % 10 <> 3")),
    ("is_valid", "CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE NULL END AS INT)"),
    ("created_at", "CAST(date_trunc('month', o_orderdate) AS TIMESTAMP)"),
    ("job_req_id", "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'AREQ' || CAST(o_orderkey % 500 AS STRING) END"),
    ("requisition_id", "CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'RQ' || CAST(o_orderkey AS STRING) END"),
    ("job_title", "CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'title ' || o_orderpriority END"),
    ("city", "'city ' || CAST(o_orderkey % 40 AS STRING)"),
    ("state", "'st' || CAST(o_orderkey % 9 AS STRING)"),
    ("chat_to_apply_type", "CAST(o_orderkey % 3 AS INT)"),
    ("job_loc_id", "o_orderkey % 97"),
    ("job_id", "o_orderkey % 2000"),
    ("extra_data", "CASE o_orderkey % 5 WHEN 0 THEN '{\"is_internal_job_feed\": true}' "
                   "WHEN 1 THEN '{\"is_internal_job_feed\": \"true\"}' "
                   "WHEN 2 THEN '{\"is_internal_job_feed\": false}' WHEN 3 THEN NULL ELSE 'not json' END"),
)))

_add(Role("recorded_candidate", "orders", (
    ("id", "o_orderkey"),
    ("lead_id", "o_custkey"),
    ("status", "CAST(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS INT)"),
)))

_add(Role("recorded_message", "lineitem", (
    ("recorded_itv_candidate_id", "l_orderkey"),
    ("message_type", "CAST(CASE WHEN l_returnflag = 'R' THEN 2 WHEN l_returnflag = 'A' THEN 1 ELSE 3 END AS INT)"),
    ("created_at", "l_shipdate"),
)))

_add(Role("meeting", "events", (
    ("id", "event_id"),
    ("lead_id", "user_id"),
    ("external_id", "CASE WHEN event_type = 'click' THEN '' ELSE 'mt-' || CAST(event_id AS STRING) END"),
    ("provider", "CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS INT)"),
    ("duration", "CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value * 100) AS BIGINT) END"),
)))

_add(Role("contact", "customer", (
    ("user_id", f"CASE WHEN {K} % 20 = 11 THEN {K} - 1 ELSE {K} END"),
    ("name", "'contact ' || c_name"),
    ("phone_number", f"'+4' || {_s(K)}"),
)))

_add(Role("company_user", "customer", (
    ("user_id", _nowhere(K, f"{K} % 2 = 0")),
    ("company_id", "c_nationkey"),
    ("acl_role_id", f"CAST({K} % 5 AS INT)"),
    ("job_email", f"'u' || {_s(K)} || '@corp.example'"),
    ("employee_id", f"'E' || {_s(f'{K} % 100')}"),
    ("role", f"CASE {K} % 3 WHEN 0 THEN 'recruiter' WHEN 1 THEN 'manager' ELSE NULL END"),
    ("type", f"CAST({K} % 2 AS INT)"),
    ("tz_str", "'UTC'"),
    ("job_title", "'staff'"),
)))

_add(Role("event_candidate", "orders", (
    ("event_id", "CAST(o_orderkey % 25 AS INT)"),
    ("lead_id", "o_custkey"),
)))

_add(Role("event", "nation", (
    ("id", "n_nationkey"),
    ("company_id", "n_regionkey"),
    ("name", "'event ' || n_name"),
)))

_add(Role("widget", "part", (
    ("id", "p_partkey"),
    ("company_id", "CAST(p_partkey % 25 AS INT)"),
    ("widget_type", "CAST(CASE WHEN p_partkey % 6 = 5 THEN NULL ELSE p_partkey % 6 END AS INT)"),
    ("name", "CASE WHEN p_partkey % 8 = 7 THEN NULL ELSE p_name END"),
    ("compsite_slug", "'site-' || CAST(p_partkey AS STRING)"),
)))

_add(Role("campaign_contact", "orders", (
    ("campaign_id", "CAST((o_orderkey + 3) % 25 AS INT)"),
    ("lead_id", _nowhere("o_custkey", "o_orderkey % 3 = 0")),
)))

_add(Role("outbound_campaign", "nation", (
    ("id", "n_nationkey"),
    ("company_id", "n_regionkey"),
    ("name", "'camp ' || n_name"),
)))

_add(Role("auth_user", "customer", (
    ("id", _nowhere(K, f"{K} % 3 <> 0")),
    ("name", "'user ' || c_name"),
)))

_add(Role("employee", "customer", (
    ("id", f"{K} + 1"),
    ("company_id", "c_nationkey"),
    ("name", f"CASE WHEN {K} % 18 = 0 THEN NULL ELSE c_name END"),
    ("email", f"'emp' || {_s(K)} || '@corp.example'"),
    ("phone_number", f"'+5' || {_s(K)}"),
)))

_add(Role("external_map", "customer", (
    ("company_id", "c_nationkey"),
    ("oid", K),
    ("ex_id_1", f"'X1-' || {_s(K)}"),
    ("ex_id_2", f"CASE WHEN {K} % 5 = 0 THEN NULL ELSE 'X2-' || {_s(K)} END"),
    ("ex_id_3", f"'X3-' || {_s(f'{K} % 17')}"),
    ("ex_source", f"CASE {K} % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'Z' ELSE NULL END"),
), union_where=f"{K} % 10 = 1", union_columns=(
    ("company_id", "c_nationkey"),
    ("oid", K),
    ("ex_id_1", f"'X0-' || {_s(K)}"),
    ("ex_id_2", "NULL"),
    ("ex_id_3", f"'X9-' || {_s(K)}"),
    ("ex_source", "'A'"),
)))

_add(Role("job_family", "nation", (
    ("id", "n_nationkey"),
)))

_add(Role("pre_attendee", "customer", (
    ("user_id", f"{K} - {K} % 2"),
    ("company_id", "c_nationkey"),
    ("candidate_id", f"{K} - {K} % 3"),
)))

_add(Role("acl_role", "nation", (
    ("id", "CAST(n_nationkey % 5 AS INT)"),
    ("company_id", "n_nationkey"),
    ("name", "'role ' || n_name"),
)))

_add(Role("language", "region", (
    ("code", "lower(substr(r_name, 1, 2))"),
    ("name", "r_name"),
)))

_add(Role("applied_job_extra", "orders", (
    ("applied_job_id", "o_orderkey"),
    ("system_attribute_key_name", "CASE WHEN o_orderkey % 4 = 0 THEN 'cf_other' ELSE 'cf_custom_org' END"),
    ("custom_field_value", "'org ' || CAST(o_orderkey % 50 AS STRING)"),
), union_where="o_orderkey % 8 = 1", union_columns=(
    ("applied_job_id", "o_orderkey"),
    ("system_attribute_key_name", "'cf_custom_org'"),
    ("custom_field_value", "'org second ' || CAST(o_orderkey % 7 AS STRING)"),
)))

_add(Role("applied_job_extension", "orders", (
    ("applied_job_id", "o_orderkey"),
    ("shorten_job_id", "'sj' || CAST(o_orderkey AS STRING)"),
)))


class RoleFrames(Mapping[str, DataFrame]):
    """The roles of ``tables`` by name; a view is made when it is first asked for."""

    def __init__(self, tables: Mapping[str, DataFrame], names=None):
        self._tables, self._names = tables, tuple(names or ROLES)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name not in self._names:
                raise KeyError(name)
            self._made[name] = ROLES[name].frame(self._tables)
        return self._made[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def role_frames(tables: Mapping[str, DataFrame], names=None) -> Mapping[str, DataFrame]:
    return RoleFrames(tables, names)


def role_ctes(names) -> str:
    """``WITH``-clause body defining the given roles for the oracle."""
    return ",\n".join(f"{n} AS ({ROLES[n].sql()})" for n in names)
