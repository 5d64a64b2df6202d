"""Regular-expression matches with their places, by built-in functions alone.

``split`` gives the gaps between the matches of ``regexp_extract_all``; their
running lengths are the places, in code points. One scan of the texts finds
the matches of every kind; only matches travel further.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points kept of the text before and after a match.
CONTEXT = 80


@dataclass(frozen=True)
class Kind:
    """A kind of match: its Java pattern, and the group whose text is kept besides the whole match."""

    name: str
    pattern: str
    group: int = 0


def _found(text: Column, kind: Kind) -> Column:
    gaps = F.split(text, kind.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else whole
    after = F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(1)))
    before = F.slice(gaps, F.lit(1), F.greatest(F.size(gaps) - 1, F.lit(1)))
    rows = F.transform(
        F.arrays_zip(before.alias("g"), whole.alias("m"), part.alias("p"), after.alias("a")),
        lambda z, i: F.struct(
            F.lit(kind.name).alias("kind"),
            i.alias("i"),
            F.length(z["g"]).cast("long").alias("gap"),
            z["m"].alias("m"),
            z["p"].alias("p"),
            F.substring(z["g"], -CONTEXT, CONTEXT).alias("before"),
            F.substring(z["a"], 1, CONTEXT).alias("after"),
        ),
    )
    return F.when(text.rlike(kind.pattern), rows)


def find(docs: DataFrame, kinds: list[Kind]) -> DataFrame:
    """One row per match, and one with null ``kind`` for a document without any.

    ``docs`` has doc_id and text. Columns: row_id (of the document's row, so
    that repeated ids stay apart), doc_id, kind, i (number of the match of its
    kind), gap, m, p, before, after. To be stored before use: row_id is drawn
    from the scan.
    """
    empty = F.array().cast("array<struct<kind:string,i:int,gap:bigint,m:string,p:string,before:string,after:string>>")
    found = F.concat(*[F.coalesce(_found(F.col("text"), k), empty) for k in kinds])
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    return rows.select("row_id", "doc_id", F.explode_outer(found).alias("f")).select("row_id", "doc_id", "f.*")


def place(matches: DataFrame) -> DataFrame:
    """Adds s and e, start and end in code points, to the matches of :func:`find`."""
    order = Window.partitionBy("row_id", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    e = F.sum(F.col("gap") + F.length("m")).over(order)
    return matches.where("kind IS NOT NULL").withColumn("e", e).withColumn("s", F.col("e") - F.length("m"))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of an array of structs (.., kind, s, e), comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def cover(spans: DataFrame, width: int = 256) -> DataFrame:
    """A row per ``width``-wide stretch that a span touches, for joins of intervals by equality."""
    return spans.withColumn("stretch", F.explode(F.sequence(F.floor(F.col("s") / width), F.floor((F.col("e") - 1) / width))))


def overlapping(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Spans of ``left`` that overlap one of ``right`` in the same row (left_semi) or none (left_anti).

    ``left`` needs a unique (row_id, kind, i).
    """
    l, r = cover(left.select("row_id", "kind", "i", "s", "e")).alias("l"), cover(right.select("row_id", "s", "e")).alias("r")
    met = F.expr("l.row_id = r.row_id AND l.stretch = r.stretch AND l.s < r.e AND r.s < l.e")
    touched = l.join(r, met, "left_semi").select("row_id", "kind", "i").distinct()
    return left.join(touched, ["row_id", "kind", "i"], how)
