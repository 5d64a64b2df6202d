"""Property tests: the fallback Column builders against plain-Python
statements of the same rules, on generated rows with NULLs and blanks."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from entiprof.functions.predicates import first_non_blank
from entiprof.operators.lookups import lookup_fallback

TEXT = st.one_of(st.none(), st.just(""), st.sampled_from(["a", "b", "zz"]))


def _first_present(values, fallback):
    for v in values:
        if v is not None and v != "":
            return v
    return fallback


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(TEXT, TEXT, TEXT, TEXT), min_size=1, max_size=40))
def test_first_non_blank_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    got = [r.v for r in df.select(first_non_blank("a", "b", "c", fallback="d").alias("v")).collect()]
    assert got == [_first_present(r[:3], r[3]) for r in rows]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 50), st.one_of(st.none(), st.sampled_from(["en", "de", "xx"])),
                          st.one_of(st.none(), st.sampled_from(["en", "fr", "yy"]))),
                min_size=1, max_size=30, unique_by=lambda r: r[0]))
def test_lookup_fallback_matches_python(spark, rows):
    names = {"en": "English", "de": "German", "fr": "French"}
    dim = spark.createDataFrame(list(names.items()), "code string, name string")
    df = spark.createDataFrame(rows, "id int, detected string, chosen string")
    joined, value = lookup_fallback(df, "x", [("detected", dim, "code", "name"), ("chosen", dim, "code", "name")])
    got = {r.id: r.v for r in joined.select("x.id", value.alias("v")).collect()}
    want = {}
    for i, det, cho in rows:
        cands = [names.get(det) if det else None, names.get(cho) if cho else None, det, cho]
        want[i] = next((c for c in cands if c is not None), None)
    assert got == want
