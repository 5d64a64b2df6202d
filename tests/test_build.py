"""The build on leads that repeat or have no id, rows found together, and counts in place of repeated rows."""

from __future__ import annotations

import random

from conftest import SF_SMALL
from pyspark.sql import functions as F

from entiprof.operators.latest import LatestTarget, latest_preferred, latest_preferred_since, latest_rows
from entiprof.operators.lookups import repeat_join, rows_per_key
from entiprof.plans import assemble
from entiprof.plans.queries import ROLE_PERIOD_START, _roles


def test_every_lead_row_keeps_its_own_rows(spark):
    roles = dict(_roles(spark, SF_SMALL))
    lead = roles["lead"]
    one = lead.where("id = 5")
    twice, other = one, one.withColumn("company_id", F.col("company_id") + 1).withColumn("name", F.lit("other"))
    none = one.withColumn("id", F.lit(None).cast("long")).withColumn("name", F.lit("nobody"))
    base = assemble.assemble_base(roles).select("lead.id", "lead.name", "extra.id", "profile.id").where("lead.id = 5").collect()
    roles["lead"] = lead.unionByName(twice).unionByName(other).unionByName(none).unionByName(none)
    got = assemble.assemble_base(roles).where("lead.id = 5 OR lead.name = 'nobody'").select(
        F.col("lead.name").alias("name"), F.col("lead.company_id").alias("company"), F.col("extra.id").alias("extra"),
        F.col("profile.id").alias("profile"), F.col("area.company_id").alias("area_company"))
    by_name = {}
    for r in got.collect():
        by_name.setdefault(r.name, []).append(r)
    own = next(n for n in by_name if n not in ("other", "nobody"))
    assert len(by_name[own]) == 2 * len(base) and len(by_name["other"]) >= 1
    # without an id nothing joins by id, the rest does
    assert len(by_name["nobody"]) == 2 and all(r.extra is None and r.profile is not None for r in by_name["nobody"])
    assert all(r.area_company in (None, r.company) for rs in by_name.values() for r in rs)


def test_profiles_of_leads_that_repeat(spark):
    """Both profiles of a doubled lead have as many rows as joins of plain repeated rows give."""
    roles = dict(_roles(spark, SF_SMALL))
    since = ROLE_PERIOD_START
    roles["lead"] = roles["lead"].unionByName(roles["lead"].where("id <= 40")).unionByName(roles["lead"].where("id = 7").withColumn("id", F.lit(None).cast("long")))
    prof = assemble.build_profiles(roles, since=since)
    base = assemble.assemble_base(roles)
    filt = assemble.project_filter(base)
    filt = filt.join(assemble.latest_application(roles), "lead_id", "left").join(assemble.recorded_counts(roles), "lead_id", "left")
    filt = filt.join(assemble.application_detail(roles, since=since), "lead_id", "left")
    repeats = filt.join(assemble.repeat_profiles(roles["lead"], roles), "candidate_profile_id", "left").select("lead_id", "multi_apply_profile_id")
    src_filter, src_data = assemble.source_columns(assemble.source_star(roles))
    data = assemble.project_data(base).join(repeats, "lead_id", "left").join(assemble.attendee_sets(roles), "lead_id", "left")
    data = data.join(src_data, "lead_id", "left").join(assemble.candidate_language(roles), "lead_id", "left")
    count = lambda df, *more: {tuple(r) for r in df.groupBy("lead_id", *more).count().collect()}
    assert count(prof.data, "multi_apply_profile_id") == count(data, "multi_apply_profile_id")
    filt = filt.join(src_filter, "lead_id", "left")
    named = roles["applied_job_extra"].where("system_attribute_key_name = 'cf_custom_org'")
    values = filt.join(named, F.col("latest_apply_job_id") == F.col("applied_job_id"), "left").select("lead_id", F.col("custom_field_value").alias("job_applied_extra_org"))
    want = filt.join(values, "lead_id", "left")
    keys = ("latest_apply_job_id", "source_name", "job_applied_extra_org")
    assert count(prof.filter, *keys) == count(want, *keys)
    assert prof.filter.where("lead_id IS NULL").count() == want.where("lead_id IS NULL").count() == 1


def test_rows_found_together_equal_each_alone(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, *range(40)]), rnd.choice([None, *range(20)]), rnd.choice([None, 0, 1, 2])) for _ in range(3000)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, k int, at int, ok int").withColumn("at", F.timestamp_seconds(F.col("at") * 86400))
    valid, invalid, since = F.col("ok") == 1, F.col("ok") == 0, "1970-01-08"
    got = latest_rows(df, "k", "at", [LatestTarget("a", valid), LatestTarget("b", valid, invalid, since), LatestTarget("c", invalid, valid, "1970-01-20")])
    for flag, alone in (("a", latest_preferred(df, "k", "at", valid)), ("b", latest_preferred_since(df, "k", "at", valid, invalid, since)),
                        ("c", latest_preferred_since(df, "k", "at", invalid, valid, "1970-01-20"))):
        assert sorted(r.i for r in got.where(flag).collect()) == sorted(r.i for r in alone.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 2 and "Window" not in plan
    assert latest_rows(df.limit(0), "k", "at", [LatestTarget("a", valid)]).collect() == []


def test_applications_are_read_twice(spark, tmp_path):
    """The kept frame of the picked applications is the only reader of the applications in both profiles."""
    roles = dict(_roles(spark, SF_SMALL))
    roles["applied_job"].write.parquet(str(tmp_path / "applied_job"))
    roles["applied_job"] = spark.read.parquet(str(tmp_path / "applied_job"))
    picked = assemble.picked_applications(roles, ROLE_PERIOD_START)
    assert picked._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2
    prof = assemble.build_profiles(roles, since=ROLE_PERIOD_START, materialize_mode="table")
    try:
        for df in (prof.filter, prof.data):
            assert not any(str(tmp_path) in f for f in df.inputFiles())
    finally:
        prof.release()


def test_repeat_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    counted = spark.createDataFrame([(1, "x", 2), (1, None, 1), (3, "z", 5)], "k long, w string, copies long")
    got = sorted(((r.k, r.v, r.w) for r in repeat_join(left, counted, "k").collect()), key=str)
    assert got == sorted([(1, v, w) for v in "ab" for w in ("x", "x", None)] + [(2, "c", None), (None, "d", None)], key=str)
    assert {(r.k, r.copies) for r in rows_per_key(left, "k").collect()} == {(1, 2), (2, 1)}


def test_gathered_areas_equal_a_row_each(spark):
    """Areas and job locations that repeat, are NULL or are missing: the sets stand for the rows of the plain chain."""
    rnd = random.Random(5)
    draw = lambda n: rnd.choice([None, *range(n), *range(n), *range(n)])

    def table(columns, rows, *ranges):
        made = [(i, *[draw(n) for n in ranges]) for i in range(rows)]
        return spark.createDataFrame(made + made[:3], ", ".join(f"{x} long" for x in columns.split()))

    t = {
        "lead": table("id company_id candidate_profile_id job_loc_id", 60, 3, 20, 4),
        "lead_extra": table("id lead_id journey_stage_id journey_status_id job_req_id", 90, 50, 3, 3, 6),
        "candidate_profile": table("id", 20), "journey_stage": table("id company_id", 3, 3), "stage_status": table("id stage_id", 3, 3),
        "job_loc": table("id is_deleted", 4, 2), "job": table("id job_req_id base_id company_brand_id", 10, 6, 4, 4),
        "company_brand": table("id status", 4, 2), "live_job": table("id job_id job_req_id job_loc_id", 30, 10, 6, 4),
        "event_itv_lead": table("id lead_id", 40, 60), "previous_application": table("id application_id", 40, 60),
        "job_location": table("id job_id company_area_id", 90, 10, 12).withColumn("id", F.expr("nullif(id, 5)")),
    }
    areas = [(draw(12), draw(4), draw(3)) for _ in range(40)]
    t["company_area"] = spark.createDataFrame(areas + areas[:9] + [(None, 1, 1), (None, 1, 1), (None, 2, 0)], "id long, job_loc_id long, company_id long")

    def counts(df, *columns, n):
        return sorted(map(tuple, df.select(*[F.expr(f"{x} AS c{i}") for i, x in enumerate(columns)], n.alias("n")).groupBy(*[f"c{i}" for i in range(len(columns))]).agg(F.sum("n")).collect()), key=str)

    one, own = F.lit(1), ("lead.id", "lead.job_loc_id", "extra.id", "job.id", "jl.id", "live.id")
    plain = assemble.assemble_base(t)
    assert plain.where("jloc.id IS NOT NULL").count() > 100 and plain.where("area.job_loc_id IS NOT NULL AND area.id IS NULL").count() > 5
    for heavy in (None, {"jloc.company_area_id": {3: 4}, "lk.job_loc_id": {1: 3, 2: 2}}):
        got = assemble.gathered_base(t, heavy)
        assert counts(got, *own, n=F.col("__rows")) == counts(plain, *own, n=one)
        by_area = got.select("*", F.explode("__areas").alias("a"))
        assert counts(by_area, *own, "a", n=F.col("__times")) == counts(plain, *own, "area.id", n=one)
        by_place = got.select("*", F.explode("__places").alias("p"))
        assert counts(by_place, *own, "p.id", n=F.col("p.rows")) == counts(plain, *own, "jloc.id", n=one)


def test_stored_rows_do_not_grow_with_the_areas_of_a_place(spark):
    roles = dict(_roles(spark, SF_SMALL))
    places = roles["lead"].select("job_loc_id", "company_id").distinct()
    made = []
    for n in (1, 6):
        roles["company_area"] = places.withColumn("id", F.explode(F.sequence(F.lit(1000001).cast("long"), F.lit(1000000 + n).cast("long"))))
        made.append(assemble.build_profiles(roles, since=ROLE_PERIOD_START))
    one, six = made
    assert six.counted_data.count() == one.counted_data.count() and six.data.count() > 6 * one.data.count()
