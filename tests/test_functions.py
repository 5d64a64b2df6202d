"""Scalar functions and aggregates on hand-made edge rows (FIXTURES §3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from entiprof.codes import Codes
from entiprof.functions.predicates import (
    first_non_blank,
    json_flag,
    map_lookup,
    source_lead_predicate,
    span_seconds,
    valid_name_flag,
)
from entiprof.operators.aggregates import conditional_span, set_concat, sum_count


def test_json_flag(spark):
    rows = [('{"b":true}',), ('{"b":"true"}',), ('{"b":1}',), ("bad",), (None,)]
    df = spark.createDataFrame(rows, "j string")
    got = [r.f for r in df.select(json_flag("j", "$.b").alias("f")).collect()]
    assert got == [True, True, False, False, False]


def test_map_lookup(spark):
    df = spark.createDataFrame([(None,), ("A",), ("Q",)], "k string")
    got = [r.v for r in df.select(map_lookup({"A": "Alpha"}, "k").alias("v")).collect()]
    assert got == [None, "Alpha", None]


def test_set_concat_all_null_and_sorting(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "b"), (2, "a"), (2, "b")], "g int, v string")
    got = {r.g: r.s for r in set_concat(df, "g", {"v": "s"}).collect()}
    assert got == {1: "", 2: "a,b"}


def test_span_floors_each_end(spark):
    a = dt.datetime(2024, 1, 1, 0, 0, 0, 900000)
    b = dt.datetime(2024, 1, 1, 0, 0, 2, 100000)
    df = spark.createDataFrame([(a, b)], "a timestamp, b timestamp")
    assert df.select(span_seconds("a", "b").alias("s")).first().s == 2
    ntz = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    assert ntz.select(span_seconds("a", "b").alias("s")).first().s == 2


def test_validity_flag_vs_source_filter(spark):
    removed = Codes().status_removed
    rows = [
        (1, None, 1),  # NULL name: flag false, filter drops
        (2, "an unknown", 1),  # flag false, filter keeps
        (3, "Good Name", None),  # NULL status: flag NULL, filter drops
        (4, "Test person", 1),  # both reject
        (5, "Good Name", removed),  # both reject
        (6, "Unknown x", 1),  # both reject
        (7, "", 1),  # both reject
        (8, "Fine", 1),  # both accept
    ]
    df = spark.createDataFrame(rows, "id int, name string, status int")
    flags = {r.id: r.f for r in df.select("id", valid_name_flag("name", "status", removed).alias("f")).collect()}
    assert flags == {1: False, 2: False, 3: None, 4: False, 5: False, 6: False, 7: False, 8: True}
    kept = sorted(r.id for r in df.where(source_lead_predicate("name", "status", removed)).collect())
    assert kept == [2, 8]


def test_first_non_blank(spark):
    df = spark.createDataFrame([("", None, "c", "d"), (None, "", "", "d"), ("a", "b", "c", "d")], "a string, b string, c string, d string")
    got = [r.v for r in df.select(first_non_blank("a", "b", "c", fallback="d").alias("v")).collect()]
    assert got == ["c", "d", "a"]


def test_conditional_counts(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, 2, t0), (1, 1, t0 + dt.timedelta(seconds=5)), (1, 3, t0 + dt.timedelta(seconds=65)),
            (1, None, t0 + dt.timedelta(days=9)), (2, 2, t0)]
    df = spark.createDataFrame(rows, "k int, kind int, ts timestamp")
    got = {r.k: tuple(r)[1:] for r in conditional_span(df, "k", F.col("kind") == 2, "ts").collect()}
    assert got == {1: (1, 2, 60), 2: (1, 0, None)}


def test_sum_count_null_as_zero(spark):
    df = spark.createDataFrame([(1, 1, None, "x"), (1, 2, 5, "x"), (1, 3, 7, "")], "k int, id int, d int, e string")
    got = sum_count(df, "k", "d", "id", F.col("e") != "", "total", "n").first()
    assert (got.total, got.n) == (5, 2)


def test_cluster_settings_scale_with_input():
    from entiprof.session import cluster_settings

    big = cluster_settings(100 * 1024**4, executors=1000, cores_per_executor=16)
    assert int(big["spark.sql.shuffle.partitions"]) == 409_600  # 256 MB each
    small = cluster_settings(1024**3, executors=1000, cores_per_executor=16)
    assert int(small["spark.sql.shuffle.partitions"]) == 32000  # two waves of 16k slots
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_set_concat_methods_agree(spark):
    rows = [(g % 7, None if i % 5 == 0 else f"v{i % 13}", i % 4 if i % 3 else None) for g in range(40)
            for i in range(g)]
    rows += [(99, None, None)]  # a group with only NULLs
    df = spark.createDataFrame(rows, "g int, a string, b int")
    cols = {"a": "as", "b": "bs"}
    d = set_concat(df, "g", cols)
    c = set_concat(df, "g", cols, method="collect_set")
    assert d.count() == c.count() == 8
    assert d.exceptAll(c).count() == 0 and c.exceptAll(d).count() == 0
    assert {r.g: (r["as"], r.bs) for r in d.collect()}[99] == ("", "")


def test_ntz_spans_do_not_depend_on_session_zone(spark):
    from tests.test_scale import conf

    a = dt.datetime(2024, 3, 9, 12, 0, 0, 900000)
    b = dt.datetime(2024, 3, 11, 12, 0, 2, 100000)  # across the US daylight-saving change
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    got = []
    for zone in ("UTC", "America/Los_Angeles"):
        with conf(spark, **{"spark.sql.session.timeZone": zone}):
            got.append(df.select(span_seconds("a", "b", ntz=True).alias("s")).first().s)
    assert got == [2 * 86400 + 2, 2 * 86400 + 2]


def test_restrict_to_is_a_semi_join(spark):
    from entiprof.sources.tables import restrict_to

    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    ids = spark.createDataFrame([(1,), (1,), (1,), (None,), (5,)], "id long")
    got = sorted((r.k, r.v) for r in restrict_to(df, ids, "k", "id").collect())
    assert got == [(1, "a"), (1, "b")]  # duplicates in the id set do not multiply; NULL matches nothing
