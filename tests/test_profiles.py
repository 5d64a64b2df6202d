"""Profile assembly: schemas, NULL fallbacks of the application detail,
window/aggregate agreement and the changed-id build."""

from __future__ import annotations

from pyspark.sql import functions as F

from entiprof.plans import assemble
from entiprof.plans.queries import ROLE_PERIOD_START, _roles, _t, changed_lead_ids
from tests.conftest import SF_SMALL

SF = "/root/testdata/sf0.01"


def test_profile_schemas(spark):
    prof = assemble.build_profiles(_roles(spark, SF_SMALL), since=ROLE_PERIOD_START)
    assert len(prof.filter.columns) == 66 and len(set(prof.filter.columns)) == 66
    assert len(prof.data.columns) == 57 and len(set(prof.data.columns)) == 57
    assert prof.filter.columns[:3] == ["lead_id", "company_id", "long_id"]
    assert prof.filter.columns[-1] == "job_applied_extra_org"
    assert prof.data.columns[-1] == "candidate_language"
    detail = assemble.application_detail(_roles(spark, SF_SMALL), since=ROLE_PERIOD_START)
    assert tuple(detail.columns) == ("lead_id", *assemble.APPLICATION_COLUMNS)
    assert tuple(prof.filter.columns[45:63]) == assemble.APPLICATION_COLUMNS


def test_application_detail_nulls_and_fallbacks(spark):
    roles = _roles(spark, SF)
    filt = assemble.build_profiles(roles, since=ROLE_PERIOD_START).filter
    # leads without a lead_extra row (k % 11 = 0) get no application columns
    no_extra = filt.where(F.col("lead_id") % 11 == 0)
    assert no_extra.count() > 0
    assert no_extra.where(F.col("cem_folder").isNotNull() | F.col("job_applied_log_job_title").isNotNull()).count() == 0
    # leads with lead_extra but no application in the period still get a title from the fallback chain
    detail = assemble.application_detail(roles, since=ROLE_PERIOD_START)
    no_app = detail.where(F.col("job_applied_reapply_requisition_id").isNull() & F.col("job_applied_valid_id").isNull()
                          & F.col("is_internal_job_feed").isNull())
    assert no_app.count() > 0
    assert no_app.where(F.col("job_applied_log_job_title").isNotNull()).count() > 0


def test_latest_methods_agree_on_profiles(spark):
    roles = _roles(spark, SF)
    a = assemble.latest_application(roles, "aggregate")
    w = assemble.latest_application(roles, "window")
    assert a.exceptAll(w).count() == 0 and w.exceptAll(a).count() == 0


def test_incremental_equals_full_restricted(spark):
    t = _t(spark, SF)
    roles = _roles(spark, SF)
    ids = changed_lead_ids(t)
    inc = assemble.build_profiles(roles, since=ROLE_PERIOD_START, changed_ids=ids)
    full = assemble.build_profiles(roles, since=ROLE_PERIOD_START)
    for part in ("filter", "data"):
        a = getattr(inc, part)
        b = getattr(full, part).join(ids.withColumnRenamed("id", "lead_id").distinct(), "lead_id", "left_semi")
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_write_profiles_and_empty_change_set(spark, tmp_path):
    roles = _roles(spark, SF_SMALL)
    ok = assemble.write_profiles(roles, str(tmp_path / "f"), str(tmp_path / "d"), since=ROLE_PERIOD_START)
    assert ok
    assert spark.read.parquet(str(tmp_path / "f")).count() > 0
    empty_ids = spark.createDataFrame([], "id long")
    assert not assemble.write_profiles(roles, str(tmp_path / "f2"), str(tmp_path / "d2"), changed_ids=empty_ids)


def test_stream_refresh_one_file_per_trigger_keeps_newest_epoch(spark):
    from entiprof.plans.queries import q32_incremental_profile, run_stream_refresh

    streamed = run_stream_refresh(spark, SF_SMALL, files_per_trigger=1)
    batch = q32_incremental_profile(spark, SF_SMALL)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_job_reads_tables_by_name_and_writes_both_profiles(spark, tmp_path):
    from entiprof import job
    from entiprof.plans.roles import ROLES

    assert set(job.ROLE_TABLES) == set(ROLES)
    roles = _roles(spark, SF_SMALL)
    tables_dir = tmp_path / "tables"
    for name in job.ROLE_TABLES:
        roles[name].write.parquet(str(tables_dir / f"{name}.parquet"))
    assert job.run(spark, str(tables_dir), str(tmp_path / "out"), since=ROLE_PERIOD_START)
    expected = assemble.build_profiles(roles, since=ROLE_PERIOD_START)
    for part, folder in (("filter", "filter_profile"), ("data", "data_profile")):
        got = spark.read.parquet(str(tmp_path / "out" / folder))
        want = getattr(expected, part)
        assert got.columns == want.columns
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_application_detail_fallback_chain_on_hand_rows(spark):
    import datetime as dt

    d = dt.datetime(2022, 3, 1)
    t = {
        "lead": spark.createDataFrame(
            [(1, 5, 0, 0, 0, 3, "2", 1, 9), (2, 5, 0, 0, 0, 3, "x", 1, 9), (3, 5, 0, 0, 0, 3, "1", 1, 9),
             (4, 5, 0, 0, 0, 3, "1", 1, 9)],
            "id long, company_id int, web_id long, referred_by long, apply_type int, source int, "
            "interview_type string, schedule_by int, interview_jobloc_id long"),
        "lead_extra": spark.createDataFrame(
            [(1, "", "extra title 1"), (2, "R2", ""), (3, "R3", "t3"), (4, "R4", "t4")],
            "lead_id long, job_req_id string, job_title string"),
        "job": spark.createDataFrame([(10, "R2", 1, "job two"), (11, "R3", 0, "ignored: base_id 0")],
                                     "id long, job_req_id string, base_id long, name string"),
        "applied_job": spark.createDataFrame(
            [(100, 3, 1, d, "", "", "", "c", "s", 1, 7, 8, None),
             (101, 4, 0, d, "AR", "RQ", "invalid title", "c", "s", 1, 7, 8, '{"is_internal_job_feed": "true"}')],
            "id long, lead_id long, is_valid int, created_at timestamp, job_req_id string, requisition_id string, "
            "job_title string, city string, state string, chat_to_apply_type int, job_loc_id long, job_id long, "
            "extra_data string"),
        "widget": spark.createDataFrame([], "id long, company_id int, widget_type int"),
        "applied_job_extension": spark.createDataFrame([(100, "short")], "applied_job_id long, shorten_job_id string"),
    }
    rows = {r.lead_id: r for r in assemble.application_detail(t, since="2021-07-01").collect()}
    # no application, blank extra requisition, no job match: falls through to the extra values as they are
    assert (rows[1].job_applied_log_job_requisition_id, rows[1].job_applied_log_job_title) == ("", "extra title 1")
    assert rows[1].is_internal_job_feed is None and rows[1].job_applied_valid_id is None
    # no application: requisition from the job (base_id > 0); title from the job name
    assert (rows[2].job_applied_log_job_requisition_id, rows[2].job_applied_log_job_title) == ("R2", "job two")
    assert rows[2].lead_interview_type is None  # 'x' is not an int
    # valid application with blank fields: job with base_id 0 does not join, so the extra values are used
    assert (rows[3].job_applied_log_job_requisition_id, rows[3].job_applied_log_job_title) == ("R3", "t3")
    assert (rows[3].job_applied_valid_id, rows[3].job_applied_shorten_job_id, rows[3].is_internal_job_feed) == (
        100, "short", False)
    # invalid application: the fallback columns are NULL and the valid-only columns too
    assert rows[4].job_applied_log_job_requisition_id is None and rows[4].job_applied_log_job_title is None
    assert rows[4].job_applied_valid_id is None and rows[4].job_applied_reapply_requisition_id == "RQ"
    assert rows[4].is_internal_job_feed is True
    assert all(r.cem_folder == 3 for r in rows.values())  # no referral / event / page: the raw source
