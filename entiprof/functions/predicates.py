"""Scalar Column builders (F1-F16): validity tests, fallbacks, JSON flag,
map lookup and second-resolution spans. All are built-in expressions, so they
stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from entiprof.codes import (
    NAME_TEST_PATTERN,
    NAME_UNKNOWN_PATTERN,
    SOURCE_FILTER_TEST_PATTERN,
    SOURCE_FILTER_UNKNOWN_PREFIX,
)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def valid_name_flag(name: Column | str, status: Column | str, removed: object) -> Column:
    """Three-valued flag (R2): status is not ``removed`` and the lower-cased
    name (NULL read as empty) is not empty and contains neither 'test' nor
    'unknown'. A NULL status gives NULL unless the name test already fails.

    ``ilike(x, p)`` is ``lower(x) LIKE lower(p)``; the name is lower-cased
    once here and matched with ``like``, so long texts are not lower-cased
    once per pattern."""
    lname = F.lower(F.coalesce(_c(name), F.lit("")))
    return (
        (_c(status) != F.lit(removed))
        & (lname != F.lit(""))
        & ~lname.like(NAME_TEST_PATTERN.lower())
        & ~lname.like(NAME_UNKNOWN_PATTERN.lower())
    )


def source_lead_predicate(name: Column | str, status: Column | str, removed: object) -> Column:
    """Row filter of the source star (P10). Unlike ``valid_name_flag`` a NULL
    name or status drops the row, and only names *starting* with 'Unknow' are
    rejected (case-insensitive matches on one lower-cased copy)."""
    n = _c(name)
    lname = F.lower(n)
    return (
        (_c(status) != F.lit(removed))
        & (n != F.lit(""))
        & ~lname.like(SOURCE_FILTER_TEST_PATTERN.lower())
        & ~lname.like(SOURCE_FILTER_UNKNOWN_PREFIX.lower())
    )


def is_present(c: Column | str) -> Column:
    """Not NULL and not the empty string."""
    col = _c(c)
    return col.isNotNull() & (col != F.lit(""))


def first_non_blank(*cols: Column | str, fallback: Column | str | None = None) -> Column:
    """First argument that is neither NULL nor '' ; else ``fallback`` as is
    (which may itself be blank or NULL)."""
    expr = None
    for c in cols:
        expr = F.when(is_present(c), _c(c)) if expr is None else expr.when(is_present(c), _c(c))
    tail = F.lit(None) if fallback is None else _c(fallback)
    return tail if expr is None else expr.otherwise(tail)


def json_equals(json_text: Column | str, path: str, text: str) -> Column:
    """True when the JSON value at ``path`` reads as ``text`` (a JSON scalar
    or string with that text); false for other values, bad JSON or NULL."""
    return F.coalesce(F.get_json_object(_c(json_text), path) == F.lit(text), F.lit(False))


def json_flag(json_text: Column | str, path: str) -> Column:
    """True for JSON ``true`` or ``"true"`` at ``path``, else false."""
    return json_equals(json_text, path, "true")


def literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def map_lookup(mapping: Mapping[str, str], key: Column | str) -> Column:
    """Value for ``key`` in a literal map; NULL for a NULL or missing key."""
    return literal_map(mapping)[_c(key)]


def epoch_seconds(ts: Column | str, ntz: bool = False) -> Column:
    """Whole seconds since the epoch (floor).

    A zone-aware timestamp is an instant: cast to seconds. A timestamp_ntz is
    a wall-clock value: its seconds are counted as if it were UTC, from its
    date and time parts, so the result does not depend on the session time
    zone (a cast would go through it, and daylight-saving changes would shift
    spans by an hour)."""
    col = _c(ts)
    if not ntz:
        return col.try_cast("timestamp").cast("long")
    return (
        F.unix_date(F.to_date(col)).cast("long") * F.lit(86400)
        + F.hour(col) * F.lit(3600)
        + F.minute(col) * F.lit(60)
        + F.second(col)
    )


def span_seconds(first: Column | str, last: Column | str, ntz: bool = False) -> Column:
    """``last - first`` with each end floored to whole seconds first."""
    return epoch_seconds(last, ntz) - epoch_seconds(first, ntz)


def is_ntz(df, column: str) -> bool:
    """Whether ``column`` of ``df`` is a timestamp without time zone."""
    return df.schema[column].dataType.typeName() == "timestamp_ntz"


def when_flag(flag: Column | str, value: Column | str, equals: int = 1) -> Column:
    """``value`` where ``flag = equals``, else NULL."""
    return F.when(_c(flag) == F.lit(equals), _c(value))
