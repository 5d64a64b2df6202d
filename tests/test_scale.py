"""Plan-shape checks for scale: hot keys, pushdown, no windows / no
cartesian products in the operators that must survive skew."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from entiprof.operators.aggregates import conditional_span_joined
from entiprof.operators.latest import latest_preferred
from entiprof.operators.lookups import JoinStep, join_chain
from entiprof.plans import assemble
from entiprof.plans import queries as Q
from tests.conftest import SF_SMALL


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot(spark, n):
    """A third of the rows share key 0."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("k"),
        (F.col("id") % 97).alias("ts"),
        (F.col("id") % 4 == 0).alias("ok"),
        F.concat(F.lit("value-"), F.col("id").cast("string")).alias("v"),
    )


def test_latest_preferred_has_no_window_and_joins_on_key_and_ts(spark):
    df = _hot(spark, 10_000)
    plan = latest_preferred(df, "k", "ts", F.col("ok"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert "Join Inner" in plan and "ts" in plan.split("Join Inner")[1].split("\n")[0]


def test_hot_key_latest_preferred_matches_window(spark):
    df = _hot(spark, 60_000)
    agg = latest_preferred(df, "k", "ts", F.col("ok"))
    win = latest_preferred(df, "k", "ts", F.col("ok"), method="window")
    assert agg.count() == win.count()
    assert agg.exceptAll(win).count() == 0


def test_hot_key_left_join_is_split_by_aqe(spark):
    with conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }):
        left = spark.range(2_000_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
            F.concat(F.lit("value-"), F.col("id").cast("string")).alias("v"),
        )
        right = spark.range(0, 2_000_000, 2).select(F.col("id").alias("k"), F.lit("x").alias("w"))
        joined = join_chain(left, "l", [JoinStep(right, "r", F.col("l.k") == F.col("r.k"))])
        out = joined.groupBy(F.col("r.w").alias("w")).agg(F.count("*").alias("n"), F.max("l.v").alias("mv"))
        got = {r.w: r.n for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert got == {"x": 1_333_333, None: 666_667}
    assert "skew=true" in plan


def test_children_are_preaggregated_before_the_join(spark):
    parents = spark.range(1000).select(F.col("id").alias("pid"), (F.col("id") % 10).alias("g"), F.lit(2).alias("st"))
    children = _hot(spark, 50_000).select(F.col("k").alias("pid"), F.col("ok"), F.col("ts").cast("timestamp").alias("at"))
    out = conditional_span_joined(parents, "pid", "g", children, "pid", F.col("ok"), "at")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    join_line = [line for line in plan.split("\n") if "Join Inner" in line][0]
    below = plan.split(join_line)[1]
    assert "Aggregate" in below  # an aggregate sits under the join (children side)


def test_no_cartesian_or_nested_loop_in_profiles(spark):
    for key in ("q30_filter_profile", "q31_data_profile", "q13_source_star"):
        plan = Q.QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_period_filter_reaches_the_scan(spark):
    plan = Q.QUERIES["q04_latest_preferred_since"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,1997-07-01" in plan


def test_changed_id_semi_joins_are_broadcast_up_front(spark):
    import re

    changed = Q.changed_lead_ids(Q._t(spark, SF_SMALL))
    df = assemble.build_profiles(Q._roles(spark, SF_SMALL), since=Q.ROLE_PERIOD_START, changed_ids=changed).data
    plan = df._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    semi = re.findall(r"(BroadcastHashJoin|SortMergeJoin) \[[^\]]*\], \[[^\]]*__restrict_key[^\]]*\], LeftSemi", initial)
    assert len(semi) >= 12
    assert all(kind == "BroadcastHashJoin" for kind in semi)


def test_growing_tables_are_not_broadcast(spark):
    """A broadcast passes through the driver whole, and the build joins dozens of tables that grow with the leads."""
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "10485760"}):
        built = assemble.build_profiles(Q._roles(spark, SF_SMALL), since=Q.ROLE_PERIOD_START, materialize_mode="table")
        for df in (built.filter, built.data):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("BroadcastHashJoin") <= 3 < plan.count("SortMergeJoin")  # languages (twice) and roles
        base = assemble.assemble_base(Q._roles(spark, SF_SMALL))
        plan = base._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2  # stages and their states
        built.release()


def test_large_change_sets_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(assemble, "PUSHED_IDS", 5)
    roles = Q._roles(spark, SF_SMALL)
    stage = assemble.Stage(spark, "table")
    for ids, kind in ((roles["lead"].select("id").limit(3), "BroadcastHashJoin"), (roles["lead"].select("id"), "SortMergeJoin")):
        cut = assemble._restrict_lead_keyed(dict(roles), ids, stage)["applied_job"]
        plan = cut._jdf.queryExecution().executedPlan().toString()
        assert f"{kind} [" in plan and cut.count() == roles["applied_job"].join(ids, F.col("lead_id") == ids["id"], "left_semi").count()
    stage.release()
