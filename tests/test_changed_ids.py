"""Changed-id runs: they leave full profiles alone, and merge into them."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from entiprof.operators.latest import latest_preferred, latest_preferred_since
from entiprof.plans.assemble import merge_profile, write_profiles
from entiprof.plans.roles import role_frames
from entiprof.sources.tables import id_set, load_tables
from entiprof.streaming.incremental import read_latest, start_refresh


def test_merge_replaces_changed_leads_and_drops_vanished_ones(spark):
    full = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "n")], "lead_id long, v string")
    delta = spark.createDataFrame([(2, "x")], "lead_id long, v string")
    ids = spark.createDataFrame([(2,), (3,), (2,), (None,)], "id long")
    got = sorted(((r.lead_id, r.v) for r in merge_profile(full, delta, ids).collect()), key=str)
    assert got == sorted([(1, "a"), (2, "x"), (None, "n")], key=str)
    assert sorted(r.id for r in id_set(ids).collect()) == [2, 3]


def test_changed_run_does_not_overwrite(spark, tmp_path):
    tables = role_frames(load_tables(spark, SF_SMALL))
    for name in ("filter", "data"):
        spark.range(1).write.parquet(str(tmp_path / name))
    some = tables["lead"].select("id").limit(3)
    with pytest.raises(AnalysisException):
        write_profiles(tables, str(tmp_path / "filter"), str(tmp_path / "data"), changed_ids=some)
    assert spark.read.parquet(str(tmp_path / "filter")).count() == 1


def test_read_latest_drops_leads_that_are_gone(spark, tmp_path):
    out = str(tmp_path / "data")
    for epoch, rows in ((0, [(1, "a"), (2, "b")]), (1, [(2, "c")])):
        spark.createDataFrame(rows, "lead_id long, v string").write.parquet(f"{out}/epoch={epoch}")
        spark.createDataFrame([(1,), (2,)], "id long").write.parquet(f"{out}_ids/epoch={epoch}")
    assert [(r.lead_id, r.v) for r in read_latest(spark, out).collect()] == [(2, "c")]


def test_refresh_needs_a_durable_checkpoint(spark, tmp_path):
    with pytest.raises(ValueError):
        start_refresh(spark, {}, str(tmp_path), str(tmp_path / "f"), str(tmp_path / "d"))


def test_latest_of_text_times(spark):
    rows = [(1, "2024-01-02 10:00:00", 1), (1, "2024-01-10 09:00:00", 0), (1, "soon", 1), (2, "2023-05-05 00:00:00", 0)]
    df = spark.createDataFrame(rows, "k long, at string, ok int")
    got = latest_preferred(df, "k", "at", F.col("ok") == 1)
    assert got.columns == ["k", "at", "ok"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "2024-01-02 10:00:00", 1), (2, "2023-05-05 00:00:00", 0)]
    since = latest_preferred_since(df, "k", "at", F.col("ok") == 1, F.col("ok") == 0, "2024-01-01")
    assert [tuple(r) for r in since.collect()] == [(1, "2024-01-02 10:00:00", 1)]
