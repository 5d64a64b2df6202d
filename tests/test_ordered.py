"""Set texts of groups of any size: equal to the plain operator, several rows past the limit, no task with a whole group."""

from __future__ import annotations

from pyspark.sql import functions as F

from entiprof.operators.aggregates import set_concat
from entiprof.operators.ordered import set_concat_parts
from entiprof.sources.sinks import Stage
from tests.test_scale import conf

COLS = {"a": "as", "b": "bs"}


def _frame(spark):
    rows = [(g % 7, None if i % 5 == 0 else f"v{i % 13}" * (i % 3), i % 4 if i % 3 else None) for g in range(40) for i in range(g)]
    rows += [(99, None, None), (None, "x", 1), (None, "y", None), (98, "", None), (97, "", 5), (97, "z", 5), (97, None, 5)]
    return spark.createDataFrame(rows, "g int, a string, b int")


def test_parts_equal_set_concat(spark):
    df = _frame(spark)
    want = {r.g: (r["as"], r.bs) for r in set_concat(df, "g", COLS).collect()}
    assert want[99] == ("", "") and want[97] == (",z", "5")
    for chunk_chars, max_chars in ((1 << 20, None), (4, None), (1, 1 << 20)):
        got = set_concat_parts(df, "g", COLS, Stage(spark, "table"), chunk_chars=chunk_chars, max_chars=max_chars).collect()
        assert len(got) == len(want) and {r.g: (r["as"], r.bs) for r in got} == want and {r.part for r in got} == {0}
    empty = set_concat_parts(df.limit(0), "g", COLS, Stage(spark, "table"))
    assert empty.columns == ["g", "part", "as", "bs"] and empty.count() == 0


def test_long_texts_stand_in_several_rows(spark):
    df = _frame(spark)
    want = {r.g: (r["as"], r.bs) for r in set_concat(df, "g", COLS).collect()}
    rows = set_concat_parts(df, "g", COLS, Stage(spark, "table"), chunk_chars=3, max_chars=6).orderBy("g", "part").collect()
    assert max(r.part for r in rows) > 1 and all(len(r["as"] or "") <= 6 + 3 + 8 for r in rows)
    joined = {g: tuple(",".join(x for r in rows if r.g == g and (x := r[c]) is not None) for c in ("as", "bs")) for g in want}
    assert joined == want


def test_a_hot_group_is_dealt_over_tasks(spark):
    """Chunks of a group with a third of the values come from several ranges, none longer than the limit and a value."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("g"), F.format_string("%08d", "id").alias("a"))
    kept = []

    class Seen(Stage):
        def keep(self, *frames):
            kept.extend(super().keep(*frames))
            return kept[-1:]

    with conf(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):  # 8 ranges, as such few rows would be one
        out = set_concat_parts(df, "g", {"a": "as"}, Seen(spark, "table"), chunk_chars=1000)
    hot = kept[0].where("g = -1").agg(F.countDistinct("__range").alias("ranges"), F.max(F.length("__text")).alias("longest"), F.count("*").alias("n")).first()
    assert hot.ranges >= 3 and hot.longest <= 1010 and hot.n >= 90
    text = out.where("g = -1").first()["as"]
    assert text == ",".join(f"{i:08d}" for i in range(0, 30_000, 3))
