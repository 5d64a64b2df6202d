"""Latest / first / last row selection (R5, R7, R8, R10b-c, R13).

Arg-max rows are found with a partial (map-side combined) aggregation of the
per-key maxima followed by an equi-join back on (key, timestamp). Compared
with a window ``rank()`` this costs one more exchange but survives a hot key:
the aggregation pre-combines on every mapper, and the join back hashes on
(key, ts), so the rows of one key spread over many reducers instead of one
window partition holding a third of the table in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiprof.operators.skew import dealt

_K, _T, _HV, _HI = "__lp_key", "__lp_ts", "__lp_has_valid", "__lp_has_invalid"
_AT = "__at"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _timed(df: DataFrame, ts: str) -> tuple[DataFrame, str]:
    """``df`` and the column to order by: ``ts`` itself, or, of a text column, its
    value as a timestamp (NULL where the text is none)."""
    if df.schema[ts].dataType.typeName() != "string":
        return df, ts
    return df.withColumn(_AT, F.col(ts).try_cast("timestamp")), _AT


def latest_preferred(
    df: DataFrame, key: str, ts: str, valid: Column, method: str = "aggregate"
) -> DataFrame:
    """Per ``key``: the rows at the newest ``ts`` among rows where ``valid``
    holds; when a key has no valid row, the rows at its newest ``ts``
    overall. Ties are all kept. Rows with a NULL key or NULL ts never qualify.
    Returns the qualifying rows of ``df`` with their own columns only."""
    df, ts = _timed(df, ts)
    base = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    if method == "window":
        pref = F.coalesce(valid, F.lit(False))
        w = Window.partitionBy(key).orderBy(pref.desc(), F.col(ts).desc())
        return base.withColumn("__lp_rank", F.rank().over(w)).where(F.col("__lp_rank") == 1).drop("__lp_rank", _AT)
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")
    maxima = base.groupBy(F.col(key).alias(_K)).agg(
        F.max(F.when(valid, F.col(ts))).alias("__mv"),
        F.max(F.col(ts)).alias("__mc"),
    )
    target = maxima.select(
        _K, F.coalesce("__mv", "__mc").alias(_T), F.col("__mv").isNotNull().alias(_HV)
    )
    joined = base.join(dealt(target), (base[key] == target[_K]) & (base[ts] == target[_T]), "inner")
    return joined.where(~F.col(_HV) | F.coalesce(valid, F.lit(False))).drop(_K, _T, _HV, _AT)


def latest_preferred_since(
    df: DataFrame, key: str, ts: str, valid: Column, invalid: Column, since: str
) -> DataFrame:
    """Variant over the rows with ``ts >= since``: if a key has a valid row,
    keep its valid rows at the newest valid ts; else if it has an invalid row,
    keep its invalid rows at the newest ts of any kind; else nothing. So a
    newer row that is neither valid nor invalid leaves the key without a row.
    Both the aggregation and the join back read only the period (the date
    predicate reaches the parquet scan)."""
    df, ts = _timed(df, ts)
    recent = df.where(F.col(key).isNotNull() & (F.col(ts) >= F.lit(since)))
    maxima = recent.groupBy(F.col(key).alias(_K)).agg(
        F.max(F.when(valid, F.col(ts))).alias("__mv"),
        F.max(F.when(invalid, F.col(ts))).alias("__mi"),
        F.max(F.col(ts)).alias("__mc"),
    )
    target = maxima.select(
        _K,
        F.coalesce("__mv", "__mc").alias(_T),
        F.col("__mv").isNotNull().alias(_HV),
        F.col("__mi").isNotNull().alias(_HI),
    )
    joined = recent.join(dealt(target), (recent[key] == target[_K]) & (recent[ts] == target[_T]), "inner")
    keep = (
        F.when(F.col(_HV), F.coalesce(valid, F.lit(False)))
        .when(F.col(_HI), F.coalesce(invalid, F.lit(False)))
        .otherwise(F.lit(False))
    )
    return joined.where(keep).drop(_K, _T, _HV, _HI, _AT)


@dataclass(frozen=True)
class LatestTarget:
    """One choice of latest rows, made known by a flag column ``flag``.

    Among the rows of a key (with ``since``: those at or after it) the valid ones
    at their newest time; of a key without any, those at its newest time, if
    ``invalid`` is not given, else the invalid ones there if the key has an invalid row."""

    flag: str
    valid: Column
    invalid: Column | None = None
    since: str | None = None


def latest_rows(df: DataFrame, key: str, ts: str, targets: Sequence[LatestTarget]) -> DataFrame:
    """The rows that any of ``targets`` picks, with one flag column per target.

    One aggregation of every target's maxima and one join back on (key, time)
    serve all targets, so ``df`` is read twice however many there are. With one
    target the flagged rows are those of :func:`latest_preferred` (no ``invalid``)
    or :func:`latest_preferred_since`. Rows with a NULL key or time never qualify."""
    df, ts = _timed(df, ts)
    base = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    sinces = [t.since for t in targets]
    if all(sinces):
        base = base.where(F.col(ts) >= F.lit(min(sinces)))
    maxima, times = [], []
    for i, t in enumerate(targets):
        at = F.col(ts) if t.since is None else F.when(F.col(ts) >= F.lit(t.since), F.col(ts))
        maxima.append(F.max(F.when(t.valid, at)).alias(f"__v{i}"))
        maxima.append(F.max(at if t.invalid is None else F.when(t.invalid, at)).alias(f"__i{i}"))
        maxima.append(F.max(at).alias(f"__c{i}"))
        times.append(F.coalesce(f"__v{i}", F.when(F.col(f"__i{i}").isNotNull(), F.col(f"__c{i}"))))
    per_key = base.groupBy(F.col(key).alias(_K)).agg(*maxima)
    wanted = per_key.select(
        _K, *[t.alias(f"__t{i}") for i, t in enumerate(times)], *[F.col(f"__v{i}").isNotNull().alias(f"__h{i}") for i in range(len(targets))],
        F.explode(F.array_distinct(F.array_compact(F.array(*times)))).alias(_T),
    )
    joined = base.join(dealt(wanted), (base[key] == wanted[_K]) & (base[ts] == wanted[_T]), "inner")
    flags = []
    for i, t in enumerate(targets):
        fits = F.when(F.col(f"__h{i}"), t.valid).otherwise(F.lit(True) if t.invalid is None else t.invalid)
        flags.append(F.coalesce((F.col(ts) == F.col(f"__t{i}")) & fits, F.lit(False)).alias(t.flag))
    own = [c for c in df.columns if c != _AT]
    return joined.select(*own, *flags).where(reduce(lambda a, b: a | b, [F.col(t.flag) for t in targets]))


def first_match(df: DataFrame, key: str, order_id: str, value: str, pred: Column | None = None,
                value_alias: str | None = None) -> DataFrame:
    """Per ``key`` among rows satisfying ``pred``: ``value`` of the row with
    the smallest ``order_id`` (a primary key). One partial aggregation."""
    src = df if pred is None else df.where(pred)
    return src.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min_by(F.col(value), F.col(order_id)).alias(value_alias or value)
    )


def last_id(df: DataFrame, key: str, order_id: str, alias: str = "last_id") -> DataFrame:
    """Per ``key``: the largest ``order_id``."""
    return df.groupBy(key).agg(F.max(order_id).alias(alias))


def group_argmax_row(
    df: DataFrame, keys: str | Sequence[str], order_id: str, values: Sequence[str], pred: Column | None = None
) -> DataFrame:
    """Per group of ``keys`` (after ``pred``): the ``values`` of the row with
    the largest ``order_id`` (a primary key), as one aggregation with
    ``max_by`` instead of max + join back."""
    src = df if pred is None else df.where(pred)
    picked = F.max_by(F.struct(*[F.col(v) for v in values]), F.col(order_id)).alias("__row")
    out = src.groupBy(*_keys(keys)).agg(picked)
    return out.select(*_keys(keys), *[F.col(f"__row.{v}").alias(v) for v in values])
