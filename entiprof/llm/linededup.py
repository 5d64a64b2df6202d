"""Line dedup: winnowing over line hashes.

A repeated passage seldom begins and ends where a text breaks its lines, so the
lines here are all runs of ``line`` consecutive words (a text wrapped from every
word on). Of each window of ``window`` line hashes the smallest is a
fingerprint: two texts that share ``line + window - 1`` words share a fingerprint.
Fingerprints meet by a join on their hash, each with its first occurrence (by
doc_id, then place); repeats within one text are found where it is read. On one diagonal neighbouring fingerprints overlap, which
verifies what lies between them; both ends are extended word by word against the
first occurrence. Runs of at least ``min_run`` words are deleted from the later
place.

An earlier text may hold only a part of a passage, and be the first occurrence of
its fingerprints. So each stretch of ``min_run`` words has one fingerprint, that
of its smallest line hash; stretches whose fingerprint's run does not contain
them meet again among the later occurrences, by their own hash, and all but the
first go. Two such stretches can only be equal if their fingerprints' runs break
at the same distance with the same word, which leaves few to compare.

Texts are read four times (fingerprints, the ends of runs, stretches left over, the
rewriting) and only those with runs are shuffled. Null text is empty. Rows with the same id and
text are one document, each returned. Other columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiprof.llm.common import bit_table, may_hold, ship, stored, text_blocks
from entiprof.llm.words import U, row_words, runs, split

LINE = 25
WINDOW = 25
MIN_RUN = 50


def _least(h: np.ndarray, w: int, at: np.ndarray | None = None, span: int = 1) -> np.ndarray:
    """The place of the smallest of the ``w`` hashes from each place on (the last of equal ones); ``at`` holds those of ``span``."""
    n = len(h)
    # by doubling: each place holds the place of the least of the next 1, 2, 4.. hashes
    at = np.arange(n) if at is None else at
    better = lambda a, b: np.where(h[b] <= h[a], b, a)
    while span * 2 <= w:
        at = better(at[: len(at) - span], at[span:])
        span *= 2
    if span < w:
        at = better(at[: n - w + 1], at[w - span :][: n - w + 1])
    return at


def winnow(h: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest of every ``window`` neighbours (the last of equal ones); of fewer, of them all."""
    return np.unique(_least(h, min(window, len(h)))) if len(h) else np.empty(0, np.int64)


def anchored(h: np.ndarray, window: int, lines: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of :func:`winnow`, and the first and last place from which ``lines`` hashes have their smallest there (-1: none)."""
    if len(h) < lines or lines < window:
        at = winnow(h, window)
        return at, np.full(len(at), -1), np.full(len(at), -1)
    every = _least(h, window)
    at = np.unique(every)
    least = _least(h, lines, every, window)
    place, lo = np.unique(least, return_index=True)  # they never go back, so each place has one range
    first, last = np.full(len(at), -1), np.full(len(at), -1)
    i = np.searchsorted(at, place)
    first[i], last[i] = lo, np.append(lo[1:], len(least)) - 1
    return at, first, last


def _key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(_key(id_col, text_col).alias("key"), F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _stretch(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading entries of x and y are equal."""
    n, at, step = min(len(x), len(y)), 0, 64
    while at < n:
        differ = np.flatnonzero(x[at : min(n, at + step)] != y[at : min(n, at + step)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 4
    return n


def own_repeats(words: np.ndarray, at: np.ndarray, hashes: np.ndarray, line: int, min_run: int) -> list[tuple[int, int]]:
    """Runs [a, e) of a text that repeat an earlier run of the same text, found from its fingerprints.

    Each fingerprint is matched with the previous equal one, so that a
    periodic stretch is one run on one diagonal.
    """
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero(hashes[order][1:] == hashes[order][:-1])
    runs_found, reached = [], {}
    for p, q in sorted(zip(at[order[same + 1]].tolist(), at[order[same]].tolist())):
        if p < reached.get(p - q, -1):
            continue
        back = _stretch(words[:p][::-1], words[:q][::-1])
        e = p + line + _stretch(words[p + line :], words[q + line :])
        reached[p - q] = e
        if e - p + back >= min_run:
            runs_found.append((p - back, e))
    return runs_found


def _prints(docs: DataFrame, line: int, window: int, min_run: int) -> DataFrame:
    """(hash, id, key, pos, e): the fingerprints of every text; and with null hash (key, pos, e) its runs that repeat itself.

    A fingerprint's e says how far before it the stretches of ``min_run`` words that it stands for
    begin: first * lines + last, or -1. Fingerprints whose stretches lie in a run that repeats are
    left out: the run goes anyway.
    """
    lines = min_run - line + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = b.column("id"), b.column("key")
            for lo, _, data, bounds in text_blocks(b):
                words, first = row_words(data, bounds, lower=False)
                every = runs(words, line)
                hs, rows, places, begins, own_runs = [], [], [], [], []
                for r, (a, e) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    if e - a < line:
                        continue
                    own = every[a : e - line + 1]
                    at, lo_i, hi_i = anchored(own, window, lines)
                    h = own[at]
                    begin = np.where(lo_i < 0, -1, (at - lo_i) * lines + at - hi_i)
                    if len(np.unique(h)) < len(h):
                        found = own_repeats(words[a:e], at, h, line, min_run)
                        own_runs += [(lo + r, x, y) for x, y in found]
                        if found:
                            x, y = np.array(sorted(found)).T
                            # the furthest end of the runs that begin no later
                            i = np.searchsorted(x, np.where(lo_i < 0, at, lo_i), "right")
                            ends = np.append(-1, np.maximum.accumulate(y))[i]
                            keep = ends < np.where(lo_i < 0, at + line, hi_i + min_run)
                            at, h, begin = at[keep], h[keep], begin[keep]
                    hs.append(h)
                    places.append(at)
                    begins.append(begin)
                    rows.append(np.full(len(at), lo + r))
                if hs:
                    row = pa.array(np.concatenate([*rows, np.array([r for r, _, _ in own_runs], np.int64)]).astype(np.int64))
                    n, m = sum(map(len, hs)), len(own_runs)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([*hs, np.zeros(m, U)]).view(np.int64), mask=np.arange(n + m) >= n),
                            ids.take(row),
                            keys.take(row),
                            pa.array(np.concatenate([*places, np.array([x for _, x, _ in own_runs], np.int64)]).astype(np.int32)),
                            pa.array(np.concatenate([*begins, np.array([y for _, _, y in own_runs], np.int64)]).astype(np.int32)),
                        ],
                        ["hash", "id", "key", "pos", "e"],
                    )

    return docs.mapInArrow(run, "hash long, id long, key long, pos int, e int")


def _seeds(prints: DataFrame, line: int, window: int, min_run: int) -> DataFrame:
    """Stretches of matched fingerprints on one diagonal: key, a, e (words of the later place), key0, a0, e0 (its first occurrence).

    And edge: (hash, pos, lo, hi) of the fingerprints that stand for runs of ``min_run`` words from lo to hi which
    reach beyond the stretch, where yet another text has the fingerprint.
    """
    lines = min_run - line + 1
    first = prints.groupBy("hash").agg(F.min(F.struct("id", "key", "pos")).alias("f"), F.count("*").alias("n")).where("n > 1")
    met = prints.join(first, "hash").where("id <> f.id OR key <> f.key OR pos <> f.pos")
    more = F.expr("n > 2 AND e >= 0")
    mark = [F.when(more, F.col(c)).alias(c) for c in ("hash", "e")]
    met = met.select("key", "pos", F.col("f.key").alias("key0"), (F.col("pos") - F.col("f.pos")).alias("shift"), *mark).distinct()
    order = Window.partitionBy("key", "key0", "shift").orderBy("pos")
    # fingerprints of one run stand at most a window apart: their lines touch
    cut = F.when(F.col("pos") - F.lag("pos").over(order) <= min(line, window), 0).otherwise(1)
    met = met.withColumn("cut", cut).withColumn("part", F.sum("cut").over(order))
    lo, hi = F.expr(f"pos - e div {lines}").cast("int"), F.expr(f"pos - e % {lines}").cast("int")
    edge = F.collect_list(F.when(F.col("e").isNotNull(), F.struct("hash", "pos", lo.alias("lo"), hi.alias("hi"))))
    stretch = met.groupBy("key", "key0", "shift", "part").agg(F.min("pos").alias("a"), (F.max("pos") + line).alias("e"), edge.alias("edge"))
    stretch = stretch.withColumn("edge", F.expr(f"filter(edge, x -> x.lo < a OR x.hi + {min_run} > e)"))
    shifted = lambda c: (F.col(c) - F.col("shift")).cast("int").alias(f"{c}0")
    return stretch.select("key", "key0", "a", "e", shifted("a"), shifted("e"), "edge")


def _sides(docs: DataFrame, ends: DataFrame, reach: int) -> DataFrame:
    """For distinct places (key, a, e): the 32-bit hashes of up to ``reach`` words before a, nearest first, and from e on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            asked, keys = b.column("asked").to_pylist(), b.column("key").to_pylist()
            out: list[tuple] = []
            for lo, hi, data, bounds in text_blocks(b):
                words, first = row_words(data, bounds, lower=False)
                for r in range(lo, hi):
                    own = (words[first[r - lo] : first[r - lo + 1]] >> U(32)).astype(np.uint32)
                    for x in asked[r]:
                        out.append((keys[r], x["a"], x["e"], own[max(0, x["a"] - reach) : x["a"]][::-1].tobytes(), own[x["e"] : x["e"] + reach].tobytes()))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], ["key", "a", "e", "before", "after"])

    asked = ends.groupBy("key").agg(F.collect_list(F.struct("a", "e")).alias("asked"))  # no more than the text has words
    once = may_hold(docs, "key", bit_table(ends, "key")).groupBy("key").agg(F.min("text").alias("text"))
    return once.join(asked, "key").select("key", "text", "asked").mapInArrow(run, "key long, a int, e int, before binary, after binary")


def _common(x: pa.Array, y: pa.Array) -> tuple[list[int], list[int | None]]:
    """Of each two sequences of hashes, how many at the start are equal, and what x has next."""
    out, then = [], []
    for p, q in zip(x.to_pylist(), y.to_pylist()):
        a, b = np.frombuffer(p, np.uint32), np.frombuffer(q, np.uint32)
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        out.append(int(differ[0]) if len(differ) else n)
        then.append(int(a[out[-1]]) if out[-1] < len(a) else None)
    return out, then


def _left_over(docs: DataFrame, met: DataFrame, min_run: int) -> DataFrame:
    """(key, a, e): runs of ``min_run`` words that occur earlier, among those that their fingerprint's run does not contain.

    ``met``: key, a, e, edge, and before, after: the words (hashed) on which a run broke. Its
    first occurrence has none of these runs, else they would lie in it.
    """
    beyond = met.where("size(edge) > 0").select("key", "a", "e", "before", "after", F.explode("edge").alias("x")).select("key", "a", "e", "before", "after", "x.*")
    left = beyond.where("before IS NOT NULL AND lo < a").select("key", F.xxhash64("hash", F.expr("a - pos"), "before").alias("meet"), "lo", F.expr("least(hi, a - 1)").alias("hi"))
    right = beyond.where(f"after IS NOT NULL AND hi + {min_run} > e").select("key", F.xxhash64("hash", F.expr("e - pos"), "after").alias("meet"), F.expr(f"greatest(lo, e - {min_run - 1})").alias("lo"), "hi")
    asked = stored(left.unionByName(right), "line-left")
    several = asked.groupBy("meet").count().where("count > 1")
    asked = stored(asked.join(several, "meet", "left_semi").groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("asked")), "line-asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            asked = b.column("asked").to_pylist()
            for lo, hi, data, bounds in text_blocks(b):
                words, first = row_words(data, bounds, lower=False)
                found, rows, places = [], [], []
                for r in range(lo, hi):
                    own = words[first[r - lo] : first[r - lo + 1]]
                    wanted = np.unique(np.concatenate([np.arange(x["lo"], x["hi"] + 1) for x in asked[r]]))
                    ends = np.flatnonzero(np.append(np.diff(wanted) > min_run, True)).tolist()
                    for i, j in zip([0, *(x + 1 for x in ends[:-1])], ends):
                        at = wanted[i : j + 1]
                        found.append(runs(own[at[0] : at[-1] + min_run], min_run)[at - at[0]])
                        places.append(at)
                        rows.append(np.full(len(at), r))
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), b.column("id").take(row), b.column("key").take(row), pa.array(np.concatenate(places).astype(np.int32))],
                    ["hash", "id", "key", "a"],
                )

    once = may_hold(docs, "key", bit_table(asked, "key")).groupBy("key").agg(F.min("id").alias("id"), F.min("text").alias("text"))
    every = stored(once.join(asked, "key").select("key", "id", "text", "asked").mapInArrow(run, "hash long, id long, key long, a int"), "line-rest")
    first = every.groupBy("hash").agg(F.min(F.struct("id", "key", "a")).alias("f"), F.count("*").alias("n")).where("n > 1")
    later = every.join(first, "hash").where("key <> f.key OR a <> f.a")
    return later.select("key", "a", (F.col("a") + min_run).alias("e"))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", line: int = LINE, window: int = WINDOW, min_run: int = MIN_RUN) -> DataFrame:
    """(key, runs): per document with later repeats the word ranges [a, e) to delete, merged and sorted."""
    docs = _keyed(docs, id_col, text_col)
    prints = stored(_prints(docs, line, window, min_run), "line-prints")
    seeds = stored(_seeds(prints.where("hash IS NOT NULL"), line, window, min_run), "line-seeds")
    here = seeds.select("key", "a", "e")
    there = seeds.select(F.col("key0").alias("key"), F.col("a0").alias("a"), F.col("e0").alias("e"))
    # a neighbouring fingerprint may have occurred first in another text, so a run can go on for more than a window
    sides = stored(_sides(docs, stored(here.unionByName(there).distinct(), "line-ends"), 2 * min_run), "line-sides")
    x = sides.select("key", "a", "e", F.col("before").alias("b"), F.col("after").alias("f"))
    y = sides.select(F.col("key").alias("key0"), F.col("a").alias("a0"), F.col("e").alias("e0"), F.col("before").alias("b0"), F.col("after").alias("f0"))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            back, before = _common(b.column("b"), b.column("b0"))
            on, after = _common(b.column("f"), b.column("f0"))
            a, e = pc.subtract(b.column("a"), pa.array(back, pa.int32())), pc.add(b.column("e"), pa.array(on, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("key"), a, e, b.column("edge"), pa.array(before, pa.int64()), pa.array(after, pa.int64())], ["key", "a", "e", "edge", "before", "after"])

    met = seeds.join(x, ["key", "a", "e"]).join(y, ["key0", "a0", "e0"])
    kinds = f"key long, a int, e int, edge {seeds.schema['edge'].dataType.simpleString()}, before long, after long"
    met = stored(met.select("key", "a", "e", "edge", "b", "b0", "f", "f0").mapInArrow(extend, kinds), "line-met")
    ranges = met.where(F.col("e") - F.col("a") >= min_run).select("key", "a", "e")
    ranges = ranges.unionByName(_left_over(docs, met, min_run))
    ranges = ranges.unionByName(prints.where("hash IS NULL").select("key", F.col("pos").alias("a"), "e")).distinct()
    return stored(ranges.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("a", "e"))).alias("runs")), "line-runs")


def _cut(text: bytes, ranges: list[dict]) -> tuple[bytes, int, int]:
    """The text without the word ranges, how many words it had, and how many went. The blanks after a deleted run go with it, but for a line's end."""
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = split(data, np.array([0, len(data)]))
    drop = np.zeros(len(starts) + 1, np.int64)
    for r in ranges:
        drop[r["a"]] += 1
        drop[r["e"]] -= 1
    gone = np.cumsum(drop[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
    out, at = [], 0
    for a, e in zip(edges[0::2].tolist(), edges[1::2].tolist()):
        out.append(text[at : starts[a]])
        at = int(ends[e - 1])
        while at < len(text) and text[at] in b" \t":
            at += 1
    out.append(text[at:])
    return b"".join(out), len(starts), int(gone.sum())


def _rewritten(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """``docs`` with the deduplicated text in place, and __words and __gone (null where nothing went)."""
    ship(docs.sparkSession)
    found = repeated_runs(docs, id_col, text_col, **options)
    keyed = docs.withColumn("__key", _key(id_col, text_col))
    table = bit_table(found, "key")

    @F.arrow_udf("text string, words long, gone long")
    def cut(text: pa.Array, ranges: pa.Array) -> pa.Array:
        done = [_cut(t.as_py().encode(), r.as_py()) for t, r in zip(text, ranges)]
        columns = zip(*done) if done else ([], [], [])
        kinds = (pa.binary(), pa.int64(), pa.int64())
        made = [pa.array(list(c), t) for c, t in zip(columns, kinds)]
        return pa.StructArray.from_arrays([made[0].cast(pa.string()), *made[1:]], ["text", "words", "gone"])

    maybe = may_hold(keyed, "__key", table).join(found.withColumnRenamed("key", "__key"), "__key", "left")
    untouched = maybe.where("runs IS NULL").withColumns({"__words": F.lit(None).cast("long"), "__gone": F.lit(None).cast("long")})
    changed = maybe.where("runs IS NOT NULL").withColumn("__new", cut(F.col(text_col), F.col("runs")))
    changed = changed.withColumns({text_col: F.col("__new.text"), "__words": F.col("__new.words"), "__gone": F.col("__new.gone")})
    rest = may_hold(keyed, "__key", table, present=False).withColumns({"__words": F.lit(None).cast("long"), "__gone": F.lit(None).cast("long")})
    columns = [*docs.columns, "__words", "__gone"]
    return rest.select(columns).unionByName(untouched.select(columns)).unionByName(changed.select(columns))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with later repeated runs deleted from their texts; documents of which no word is left go."""
    out = _rewritten(docs, id_col, text_col, **options)
    return out.where("__gone IS NULL OR __gone < __words").drop("__words", "__gone")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_removed (words deleted), text (what is left), for every row."""
    out = _rewritten(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text", **options)
    return out.select("doc_id", F.coalesce("__gone", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("text", F.lit("")).alias("text"))
