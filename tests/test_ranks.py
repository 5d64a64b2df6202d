"""String maxima by ordered numbers: the plain operator's results, without a sort before the aggregate."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from entiprof.operators.aggregates import joined_max
from entiprof.operators.ranks import joined_max_by_number, ordered_numbers
from entiprof.plans import assemble
from entiprof.plans import queries as Q
from entiprof.plans.roles import role_frames
from entiprof.sources.sinks import Stage
from entiprof.sources.tables import load_tables
from tests.conftest import SF_SMALL

c = F.col
NAMES = ["", "a", "A", "a ", "aa", "Z", "é", "￿", "\U0001f600", None, "a", "b" * 300]


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_follow_the_order_of_strings(spark):
    df = spark.createDataFrame([(f"n{i * 7919 % 5000:05d}",) for i in range(5000)] + [(n,) for n in NAMES], "v string")
    (got,) = ordered_numbers(("v", df, c("v")), stage=Stage(spark, "table"))
    rows = sorted(got.collect(), key=lambda r: r.number)
    want = sorted({r.v for r in df.collect() if r.v is not None}, key=lambda v: v.encode())
    assert [r.value for r in rows] == want and len({r.number for r in rows}) == len(want)
    with pytest.raises(ValueError):
        ordered_numbers(("v", df, c("v")), stage=Stage(spark, None))


def test_equals_the_plain_maximum(spark):
    dims = spark.createDataFrame([(i, i % 3, n) for i, n in enumerate(NAMES)] + [(3, 1, "twice"), (None, 1, "never")], "id int, co int, name string")
    # a third of all facts on one id; ids without a match; NULL groups
    facts = spark.range(3000).select(
        F.when(c("id") % 3 == 0, F.lit(9)).when(c("id") % 17 == 0, F.lit(None)).otherwise(c("id") % 15).cast("int").alias("d"),
        F.when(c("id") % 11 == 0, F.lit(None)).otherwise(c("id") % 40).alias("g"))
    for f, d in ((facts, dims), (facts.limit(0), dims), (facts, dims.limit(0)), (facts, dims.where("name IS NULL"))):
        args = f.alias("f"), d.alias("d"), c("d.id") == c("f.d"), [c("d.co").alias("co"), c("f.g").alias("g")], c("d.name")
        (numbers,) = ordered_numbers(("name", d, c("name")), stage=Stage(spark, "table"))
        got, want = joined_max_by_number(*args, numbers), joined_max(*args)
        assert got.columns == want.columns
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("key", ["q09_max_name", "q28_max_name_campaign"])
def test_no_sort_before_the_aggregate(spark, key):
    plan = _plan(Q.QUERIES[key](spark, SF_SMALL))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_star_by_number_equals_the_lazy_star(spark):
    t = role_frames(load_tables(spark, SF_SMALL))
    stage = Stage(spark, "table")
    cols = ["lead.id", c("evt.name").alias("event"), c("camp.name").alias("campaign")]
    got, want = assemble.source_star(t, stage=stage).select(*cols), assemble.source_star(t).select(*cols)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert got.where("event IS NOT NULL").count() and got.where("campaign IS NOT NULL").count()
    stage.release()
