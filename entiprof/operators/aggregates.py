"""Grouped aggregates (A2-A12). All are plain ``groupBy().agg()`` with
built-in functions, so Spark plans a partial aggregate before the exchange
and a final one after it: a hot key is pre-combined on every mapper."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiprof.functions.predicates import is_ntz, span_seconds
from entiprof.operators.skew import dealt


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def conditional_span(
    df: DataFrame,
    key: str,
    is_question: Column,
    ts: str,
    question_alias: str = "question_total",
    answer_alias: str = "response_count",
    span_alias: str = "response_span_seconds",
) -> DataFrame:
    """Per ``key``: rows where ``is_question`` holds, rows where it is false
    (NULL counts in neither), and the seconds between the first and the last
    of the latter (each end floored to whole seconds)."""
    is_answer = ~is_question
    agg = df.groupBy(key).agg(
        F.count(F.when(is_question, F.lit(1))).alias(question_alias),
        F.count(F.when(is_answer, F.lit(1))).alias(answer_alias),
        F.min(F.when(is_answer, F.col(ts))).alias("__first"),
        F.max(F.when(is_answer, F.col(ts))).alias("__last"),
    )
    ntz = is_ntz(df, ts)
    return agg.select(
        key, question_alias, answer_alias, span_seconds("__first", "__last", ntz).alias(span_alias)
    )


def conditional_span_joined(
    parents: DataFrame,
    parent_id: str,
    group_key: str,
    children: DataFrame,
    child_fk: str,
    is_question: Column,
    ts: str,
    parent_pred: Column | None = None,
    question_alias: str = "question_total",
    answer_alias: str = "response_count",
    span_alias: str = "response_span_seconds",
) -> DataFrame:
    """``conditional_span`` of the children joined (inner) to their parents,
    grouped by a parent column.

    Children are pre-aggregated per parent id before the join: only one
    partial row per parent crosses the exchange, and a parent with a huge
    number of children is one row, not a skewed join key. The per-group
    result combines the partials (sum of counts, min of minima, max of
    maxima), which equals aggregating the joined rows, including the
    multiplicity of parents that share an id."""
    is_answer = ~is_question
    per_parent = children.groupBy(F.col(child_fk).alias("__pid")).agg(
        F.count(F.when(is_question, F.lit(1))).alias("__q"),
        F.count(F.when(is_answer, F.lit(1))).alias("__a"),
        F.min(F.when(is_answer, F.col(ts))).alias("__first"),
        F.max(F.when(is_answer, F.col(ts))).alias("__last"),
    )
    src = parents if parent_pred is None else parents.where(parent_pred)
    src = src.select(F.col(parent_id).alias("__parent"), F.col(group_key))
    joined = src.join(dealt(per_parent), F.col("__parent") == F.col("__pid"), "inner")
    per_group = joined.groupBy(group_key).agg(
        F.sum("__q").alias(question_alias),
        F.sum("__a").alias(answer_alias),
        F.min("__first").alias("__first"),
        F.max("__last").alias("__last"),
    )
    ntz = is_ntz(children, ts)
    return per_group.select(
        group_key, question_alias, answer_alias, span_seconds("__first", "__last", ntz).alias(span_alias)
    )


def sum_count(
    df: DataFrame,
    key: str,
    amount: str,
    counted: str,
    pred: Column | None = None,
    sum_alias: str = "total",
    count_alias: str = "n",
) -> DataFrame:
    """Per ``key`` after ``pred``: sum of ``amount`` with NULL read as 0, and
    the count of non-NULL ``counted``."""
    src = df if pred is None else df.where(pred)
    return src.groupBy(key).agg(
        F.sum(F.coalesce(F.col(amount), F.lit(0))).alias(sum_alias),
        F.count(F.col(counted)).alias(count_alias),
    )


def group_maxes(df: DataFrame, keys: str | Sequence[str], cols: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Per group: the max of each column on its own (values may come from
    different rows). ``cols`` may map column -> output name."""
    pairs = cols.items() if isinstance(cols, Mapping) else [(c, c) for c in cols]
    return df.groupBy(*_keys(keys)).agg(*[F.max(c).alias(a) for c, a in pairs])


def joined_max(
    facts: DataFrame,
    dims: DataFrame,
    on: Column,
    keys: Sequence[Column],
    value: Column,
    alias: str = "name",
) -> DataFrame:
    """Inner join facts to dims, then per group of ``keys`` the max of
    ``value`` (string max for names). ``on``/``keys``/``value`` use the
    aliases the caller gave ``facts`` and ``dims``."""
    return facts.join(dims, on, "inner").groupBy(*keys).agg(F.max(value).alias(alias))


def repeat_entities(
    df: DataFrame,
    key: str,
    counted: str,
    value: str,
    min_count: int = 1,
    count_alias: str = "total",
    value_alias: str | None = None,
) -> DataFrame:
    """Groups of ``key`` with more than ``min_count`` non-NULL ``counted``
    values (HAVING), with one representative ``value`` (min, deterministic;
    the value is constant per group when ``key`` is a primary key of its
    source)."""
    return (
        df.groupBy(key)
        .agg(F.count(F.col(counted)).alias(count_alias), F.min(F.col(value)).alias(value_alias or value))
        .where(F.col(count_alias) > F.lit(min_count))
    )


def sorted_set_text(col: str | Column, sep: str = ",") -> Column:
    """Distinct non-NULL values of a group as text, sorted as strings and
    joined by ``sep``; an all-NULL group gives ''."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat_ws(sep, F.array_sort(F.collect_set(c.cast("string"))))


def value_cells(cols: Sequence[str]) -> Column:
    """An array of (place of the column, value as text), one of each column."""
    return F.array(*[F.struct(F.lit(i).alias("__c"), F.col(c).cast("string").alias("__v")) for i, c in enumerate(cols)])


def set_concat(
    df: DataFrame,
    keys: str | Sequence[str],
    cols: Mapping[str, str],
    sep: str = ",",
    method: str = "distinct_first",
) -> DataFrame:
    """Per group: for each input column (mapped to an output name) the
    sorted distinct values joined by ``sep``; '' when a column has no value.

    ``distinct_first`` (default) turns rows into ``(keys, column, value)``
    and de-duplicates them in an exchange hashed on the value as well, so a
    group holding a large share of the rows is spread over many reducers;
    the per-group step then receives each distinct value once, which is the
    size of its output (groups without a bound: ``ordered.set_concat_parts``). ``collect_set`` is the one-exchange form: each map
    task sends its partial set per group, so a hot group receives one set
    per map task."""
    ks = _keys(keys)
    pairs = list(cols.items())
    if method == "collect_set":
        return df.groupBy(*ks).agg(*[sorted_set_text(c, sep).alias(a) for c, a in pairs])
    if method != "distinct_first":
        raise ValueError(f"unknown method {method!r}")
    # NULL values stay (one per group and column after the distinct) so that a
    # group whose values are all NULL still appears, with ''.
    long = df.select(*ks, F.inline(value_cells(list(cols)))).distinct()
    return long.groupBy(*ks).agg(*[
        F.concat_ws(sep, F.array_sort(F.collect_list(F.when(F.col("__c") == i, F.col("__v"))))).alias(a)
        for i, (_, a) in enumerate(pairs)
    ])
