"""Lookups (R15, R16) and left-join chains."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiprof.operators.skew import Skew, dealt


#: Column of tables that are kept with equal rows counted: how many a row stands for.
COPIES = "__copies"


@dataclass(frozen=True)
class JoinStep:
    """One right side of a join chain: a frame, its alias and an ON
    condition written with alias-qualified columns (``F.col('a.x')``).

    ``key``: the pair of columns of ``on`` that may gather rows on few values, as (left
    column, or the name of its heavy values and an expression; column of ``frame``). ``fixed``: a reference
    table whose size does not follow the input's, which the planner may broadcast."""

    frame: DataFrame
    alias: str
    on: Column
    how: str = "left"
    key: tuple[str | tuple[str, Column], str] | None = None
    fixed: bool = False


def join_chain(base: DataFrame, base_alias: str, steps: Sequence[JoinStep], skew: Skew | None = None) -> DataFrame:
    """Join ``base`` to each step in order; with ``skew``, steps that name a key are salted. Later conditions may use columns
    of earlier right sides; residual (non-key) conditions stay in the ON
    clause, where Catalyst pushes right-side ones into that side's scan.
    Rows are not de-duplicated: every match multiplies, as in SQL."""
    out = base.alias(base_alias)
    for step in steps:
        right, on = step.frame, step.on
        if skew is not None and step.key is not None and step.how == "left":
            name, left_key = step.key[0] if isinstance(step.key[0], tuple) else (step.key[0], F.col(step.key[0]))
            right, same_salt = skew.salted(right, step.alias, left_key, step.key[1], name)
            on = on & same_salt
        right = right.alias(step.alias)
        out = out.join(right if step.fixed else dealt(right), on, step.how)
    return out


def lookup_fallback(
    df: DataFrame,
    df_alias: str,
    lookups: Sequence[tuple[str, DataFrame, str, str]],
    skew: Skew | None = None,
) -> tuple[DataFrame, Column]:
    """Left-join one dimension per code column of ``df`` and return the
    joined frame with the fallback column: the first looked-up value that is
    not NULL, then the first code (as text) that is not NULL.

    ``lookups`` holds ``(code column, dimension, dimension key, dimension
    value)``; the same dimension may appear several times (it is aliased per
    use). Dimensions are small reference tables; AQE turns these joins into
    broadcasts when the runtime size allows, without a hint."""
    steps, names = [], []
    for i, (code, dim, dim_key, dim_value) in enumerate(lookups):
        a = f"__lk{i}"
        on = F.col(f"{a}.{dim_key}") == F.col(f"{df_alias}.{code}")
        steps.append(JoinStep(dim, a, on, key=(f"{df_alias}.{code}", dim_key), fixed=True))
        names.append(F.col(f"{a}.{dim_value}").cast("string"))
    out = join_chain(df, df_alias, steps, skew)
    codes = [F.col(f"{df_alias}.{code}").cast("string") for code, *_ in lookups]
    return out, F.coalesce(*names, *codes)


def rows_per_key(df: DataFrame, keys: str | Sequence[str], alias: str = "copies") -> DataFrame:
    """How many rows each non-NULL key has (of several columns: the first must not be NULL)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(F.count("*").alias(alias))


def repeat_join(df: DataFrame, counted: DataFrame, key: str, copies: str = "copies") -> DataFrame:
    """Left join to rows that stand for ``copies`` equal rows each.

    ``counted`` holds the key, values and a count in place of repeated rows, so
    only distinct rows cross the exchange; the copies are made after the join. A row
    without a match stays once, its values NULL."""
    return repeat_rows(df.join(dealt(counted), key, "left"), copies)


def repeat_rows(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Every row as often as its column ``copies`` says (NULL: once), without that column."""
    return df.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce(F.col(copies), F.lit(1)).cast("long")))).drop(copies)


def attribute_values(
    refs: DataFrame,
    attrs: DataFrame,
    row_key: str,
    ref_col: str,
    attr_fk: str,
    attr_name_col: str,
    attr_name: str,
    attr_value: str,
    out_col: str,
    copies: str = "copies",
) -> DataFrame:
    """(row_key, out_col, copies): the named attribute of every reference (R16), one row per key and value.

    ``refs`` holds (row_key, ref_col, copies); a reference without the attribute counts with NULL."""
    named = attrs.where(F.col(attr_name_col) == F.lit(attr_name)).select(F.col(attr_fk).alias("__fk"), F.col(attr_value).alias(out_col))
    found = refs.join(dealt(named), F.col(ref_col) == F.col("__fk"), "left")
    return found.where(F.col(row_key).isNotNull()).groupBy(row_key, out_col).agg(F.sum(copies).alias(copies))


def attribute_lookup(
    profile: DataFrame,
    attrs: DataFrame,
    row_key: str,
    ref_col: str,
    attr_fk: str,
    attr_name_col: str,
    attr_name: str,
    attr_value: str,
    out_col: str,
) -> DataFrame:
    """Attach one named attribute to a profile and re-attach it by
    ``row_key`` (R16). The attribute rows are those with
    ``attr_name_col = attr_name``, matched on ``attr_fk = profile.ref_col``. The
    re-attach matches every row of a key with the values of all its rows, so a key
    with n profile rows and k matching attributes ends with n*n*k rows, as in
    the original job; the values travel as counts (:func:`repeat_join`)."""
    refs = profile.groupBy(row_key, ref_col).agg(F.count("*").alias("copies"))
    values = attribute_values(refs, attrs, row_key, ref_col, attr_fk, attr_name_col, attr_name, attr_value, out_col)
    return repeat_join(profile, values, row_key)
