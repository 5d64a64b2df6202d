"""Row multiplicity of the attribute re-join (n*n*k) and of the repeat
lookup through the filter profile (m*n)."""

from __future__ import annotations

from entiprof.operators.lookups import attribute_lookup


def test_attribute_rejoin_n_n_k(spark):
    # lead 1 owns n=2 profile rows (tied latest applications 10 and 11);
    # application 10 has k=1 matching attribute, 11 has none.
    profile = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "lead_id long, latest_apply_job_id long")
    attrs = spark.createDataFrame(
        [(10, "cf_custom_org", "org A"), (10, "cf_other", "zzz"), (20, "cf_custom_org", "org B"),
         (20, "cf_custom_org", "org C")],
        "applied_job_id long, system_attribute_key_name string, custom_field_value string",
    )
    out = attribute_lookup(profile, attrs, "lead_id", "latest_apply_job_id", "applied_job_id",
                           "system_attribute_key_name", "cf_custom_org", "custom_field_value", "org")
    rows = out.collect()
    per_lead = {}
    for r in rows:
        per_lead[r.lead_id] = per_lead.get(r.lead_id, 0) + 1
    # lead 1: n*n*... = 2 profile rows x 2 attached rows (one 'org A', one NULL) = 4
    # lead 2: 1 profile row x 2 attached rows (k=2) = 2
    assert per_lead == {1: 4, 2: 2}
    assert sorted((r.latest_apply_job_id, r.org or "") for r in rows if r.lead_id == 1) == [
        (10, ""), (10, "org A"), (11, ""), (11, "org A")]


def test_repeat_lookup_m_times_n(spark):
    data = spark.createDataFrame([(1, "d1"), (1, "d2"), (1, "d3")], "lead_id long, d string")  # m = 3
    filt = spark.createDataFrame([(1, 7), (1, 7)], "lead_id long, candidate_profile_id long")  # n = 2
    repeats = spark.createDataFrame([(7, "P-7")], "candidate_profile_id long, multi_apply_profile_id string")
    per_lead = filt.join(repeats, "candidate_profile_id", "left").select("lead_id", "multi_apply_profile_id")
    assert data.join(per_lead, "lead_id", "left").count() == 6
