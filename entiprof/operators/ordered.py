"""Set concatenation of groups of any size.

``set_concat`` gathers a group's distinct values in one row's arrays, so the largest
group bounds the task. Here values are dealt by ranges of (group, column, value), a
hot group over many tasks; each task makes texts of bounded length of its runs of
neighbouring values; and these chunks are put in order by their lengths alone. A
value of the result is joined from its chunks only, and a text longer than ``max_chars``
stands in several rows, which in order, joined by the separator, are the whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entiprof.operators.aggregates import value_cells
from entiprof.sources.sinks import Stage

#: Code points of a chunk, and of a value in one row (a row of Spark holds less than 2 GB, four bytes a code point).
CHUNK_CHARS = 1 << 20
ROW_CHARS = 1 << 28


def set_concat_parts(
    df: DataFrame,
    keys: str | Sequence[str],
    cols: Mapping[str, str],
    stage: Stage,
    sep: str = ",",
    chunk_chars: int = CHUNK_CHARS,
    max_chars: int | None = None,
    part_alias: str = "part",
) -> DataFrame:
    """``set_concat`` with column ``part_alias`` (from 0): one row per group unless a text passes ``max_chars``.

    In parts after the first a column without text there is NULL, so that ``concat_ws`` over a
    group's parts in order gives the whole. Values that are NULL are left out, '' is a value; a group or
    column without values gives ''; NULL keys are a group. ``stage`` keeps the chunks as a table: the ranges
    are drawn from a sample, and two readings of a plan could draw two. ``max_chars``: 2^28 shared by the columns."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    max_chars = max_chars or max(1, ROW_CHARS // len(cols))
    cell = [*ks, "__c"]
    long = df.select(*ks, F.inline(value_cells(list(cols)))).distinct()
    dealt = long.repartitionByRange(*cell, "__v").withColumn("__range", F.spark_partition_id())

    # a range's piece of a group is cut where its text reaches the next multiple of chunk_chars
    run = Window.partitionBy(*cell, "__range").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.coalesce(F.length("__v"), F.lit(0)) + len(sep)).over(run), F.lit(0))
    cut = dealt.withColumn("__chunk", F.floor(before / chunk_chars))
    values = F.array_sort(F.collect_list("__v"))
    texts = cut.groupBy(*cell, "__range", "__chunk").agg(values.alias("__values"))
    # a chunk of NULLs alone has no text, which is not the text ''
    chunks = texts.select(*cell, "__range", "__chunk", F.when(F.size("__values") > 0, F.concat_ws(sep, "__values")).alias("__text"))
    (chunks,) = stage.keep(("set-chunks", chunks))

    # lengths alone are ordered over a whole group
    order = Window.partitionBy(*cell).orderBy("__range", "__chunk").rowsBetween(Window.unboundedPreceding, -1)
    lengths = chunks.select(*cell, "__range", "__chunk", (F.coalesce(F.length("__text"), F.lit(0)) + len(sep)).alias("__n"))
    start = F.coalesce(F.sum("__n").over(order), F.lit(0))
    placed = lengths.select(*cell, "__range", "__chunk", F.floor(start / max_chars).alias(part_alias))
    a, b = chunks.alias("a"), placed.alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in (*cell, "__range", "__chunk")]
    on = same[0]
    for x in same[1:]:
        on = on & x
    parts = a.join(b, on).select("a.*", part_alias)

    def text(i: int):
        mine = F.when(F.col("__c") == i, F.struct("__range", "__chunk", "__text"))
        ordered = F.array_sort(F.collect_list(mine))
        joined = F.concat_ws(sep, F.transform(ordered, lambda x: x["__text"]))
        return F.when((F.size(ordered) > 0) | (F.col(part_alias) == 0), joined)

    return parts.groupBy(*ks, part_alias).agg(*[text(i).alias(name) for i, name in enumerate(cols.values())])
