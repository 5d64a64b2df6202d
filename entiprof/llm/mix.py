"""Mixing sources to target weights by cube-method balanced sampling.

Each source has a target number of words: its share, by weight, of a total,
but at most ``most`` times what it holds (the excess goes to the others). All its
documents are taken floor(target / size) times; the fractional rest is the
inclusion probability of one more time. The cube method draws those balanced on
words and documents: blocks of a source move their fractional
probabilities along the null space of the two constraints, which keeps both totals,
until all but a few documents are decided; the undecided of many blocks form
blocks again, until one block a source is left, whose last few documents land by
rounding while the word total is kept near. Blocks are bounded and dealt by a
hash of the row, so a source with most rows is many tasks; rows that are equal are
counted first and then dealt by their place among each other, so they are many tasks too.
Every draw follows hashes of ids and such places: reruns agree.

Null text has no words; null sources are a source, last in order; repeated
rows are documents of their own; an empty table gives an empty result. Sources
may be many: their sizes and targets stay in tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiprof.llm.common import WORD, bit_table, may_hold, ship, stored
from entiprof.llm.words import U, mix

#: Documents that one task balances at once.
BLOCK = 4096


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Of (source, source_size): source, source_key, source_size, target, the words to take of each source.

    Sources in code point order, null last, have the weights in turn; a target stops at ``most`` times
    its source's size, the excess is shared again by weight until none is above. Each round is one sum over the
    sources; those that have stopped stay so."""
    placed = sizes.withColumn("no_source", F.col("source").isNull())
    dealt = placed.repartitionByRange("no_source", "source").sortWithinPartitions("no_source", "source")
    dealt = stored(dealt.withColumn("place", F.monotonically_increasing_id()), "mix-sources")
    # a place counts the partition above and the row in it: partitions' rows before make it a number
    counts = dealt.groupBy(F.shiftright("place", 33).cast("int").alias("at")).count().collect()
    before, total = [0] * (1 + max((r["at"] for r in counts), default=0)), 0
    for r in sorted(counts):
        before[r["at"]] = total
        total += r["count"]
    start = F.element_at(F.array(*[F.lit(n).cast("long") for n in before]), F.shiftright("place", 33).cast("int") + 1)
    key = start + F.col("place").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("source_key", F.lit(len(weights))) + 1).cast("int"))
    rows = dealt.select("source", key.alias("source_key"), "source_size").withColumns({"weight": weight, "most": F.col("source_size") * float(most)})
    words = float(share * (rows.agg(F.sum("source_size")).first()[0] or 0))
    unit, stopped = 0.0, -1
    while True:
        full = F.col("weight") * unit > F.col("most")
        of = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0.0))
        r = rows.agg(of("most", full).alias("given"), of("weight", ~full).alias("weight"), F.count_if(full).alias("stopped")).first()
        if r["weight"] == 0 or r["stopped"] == stopped:
            break
        unit, stopped = (words - r["given"]) / r["weight"], r["stopped"]
    return rows.select("source", "source_key", "source_size", F.least(F.col("weight") * unit, F.col("most")).alias("target"))


def _null(a: np.ndarray) -> np.ndarray:
    """A unit vector that the rows of ``a`` map to 0."""
    a = a / np.maximum(np.abs(a).max(axis=1, keepdims=True), 1e-300)
    if a.shape == (2, 3):
        (x, y, z), (u, v, w) = a.tolist()
        n = np.array([y * w - z * v, z * u - x * w, x * v - y * u])
        if (top := float(np.abs(n).max())) > 1e-9:
            return n / top
    return np.linalg.svd(a)[2][-1]


def flight(p: np.ndarray, balance: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Move probabilities ``p`` until no more than len(balance) are fractional; ``balance @ p`` stays.

    Each step moves a few fractional entries along a null vector of their
    constraints, one of two ways, so that each keeps its expectation, until
    one of them is 0 or 1. ``draws``: a number in [0, 1) for each step.
    """
    p, m = p.copy(), len(balance)
    waiting = list(np.flatnonzero((p > 0) & (p < 1)))[::-1]
    held: list[int] = []
    step = 0
    while True:
        while len(held) <= m and waiting:
            held.append(waiting.pop())
        if len(held) <= m:
            return p
        v = _null(balance[:, held])
        x = p[held]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(v > 1e-12, (1 - x) / v, np.where(v < -1e-12, -x / v, np.inf)).min()
            down = np.where(v > 1e-12, x / v, np.where(v < -1e-12, (x - 1) / v, np.inf)).min()
        x = x + up * v if draws[step % len(draws)] * (up + down) < down else x - down * v
        step += 1
        x[x < 1e-9], x[x > 1 - 1e-9] = 0, 1
        p[held] = x
        held = [i for i in held if 0 < p[i] < 1]


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the few entries that are fractional, largest documents first, so that the words stay near their total."""
    p, debt = p.copy(), 0.0
    for i in sorted(np.flatnonzero((p > 0) & (p < 1)), key=lambda i: (-size[i], i)):
        want = p[i] * size[i] + debt
        p[i] = float(want >= 0.5 * size[i])
        debt = want - p[i] * size[i]
    return p


#: What tells rows apart; their order in a block.
_UNIT = ("h", "doc_id", "key1", "key2", "ordinal")


def _decide(rows: DataFrame, last: bool) -> DataFrame:
    """One round of flights; p is 0 or 1 for the decided."""

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([(c, "ascending") for c in _UNIT])
        size = block["size"].to_numpy().astype(float)
        # equal rows have equal hashes, but draws of their own
        h = mix(block["h"].to_numpy().astype(np.int64).view(U)) + np.arange(len(size)).astype(U)
        draws = (mix(h) >> U(11)).astype(float) / 2**53
        p = flight(block["p"].to_numpy(), np.vstack([size, np.ones(len(size))]), draws)
        return block.set_column(block.schema.get_field_index("p"), "p", pa.array(land(p, size) if last else p))

    return rows.groupBy("source_key", "block").applyInArrow(run, rows.schema)


def balanced(rows: DataFrame) -> DataFrame:
    """Adds ``taken_once`` (0 or 1) to rows (those of ``_UNIT``, source_key, size, p and others): drawn with chance p,
    balanced within each source."""
    decided = []
    open_rows = rows
    while True:
        per_source = open_rows.groupBy("source_key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        last = (per_source.agg(F.max("blocks")).first()[0] or 0) <= 1
        deal = F.pmod(F.xxhash64("h", "key1", "key2", "ordinal", F.lit(7)), "blocks")
        dealt = open_rows.join(per_source, "source_key").withColumn("block", deal).drop("blocks")
        # by both columns, lest a partitioning by source alone be taken for good enough
        dealt = dealt.repartition("source_key", "block")
        done = stored(_decide(dealt, last), "mix-round")
        decided.append(done.where("p = 0 OR p = 1"))
        if last:
            break
        open_rows = done.where("p > 0 AND p < 1").drop("block")
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out.drop("block").withColumnRenamed("p", "taken_once")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Equal rows that one task writes out.
PIECE = 1 << 16


def _one_each(counted: DataFrame) -> DataFrame:
    """Rows (.., n) as n rows with ``ordinal`` from 0; many equal rows are written by many tasks."""
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    few = counted.where(F.col("n") <= PIECE).withColumn("ordinal", upto(F.col("n")))
    pieces = counted.where(F.col("n") > PIECE).withColumn("piece", upto(F.ceil(F.col("n") / PIECE)))
    pieces = pieces.repartition("doc_id", "key1", "piece")
    many = pieces.withColumn("in_piece", upto(F.least(F.lit(PIECE).cast("long"), F.col("n") - F.col("piece") * PIECE)))
    many = many.withColumn("ordinal", F.col("piece") * PIECE + F.col("in_piece")).drop("piece", "in_piece")
    return few.unionByName(many).drop("n")


def _drawn(docs: DataFrame, id_col: str, text_col: str, source_col: str, keys: tuple[Column, Column], weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Of every row what tells it apart (``keys``, beside id, source and size), its source's size and target, and ``copies``."""
    ship(docs.sparkSession)
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
        keys[0].alias("key1"), keys[1].alias("key2"),
    )
    counted = stored(sized.groupBy(*sized.columns).agg(F.count("*").alias("n")), "mix-sizes")
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = stored(source_targets(sizes, weights, share, most), "mix-targets").withColumnRenamed("source", "of_source")
    rows = counted.join(goal, F.col("source").eqNullSafe(F.col("of_source"))).drop("source", "of_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("ratio", ratio).withColumn("whole", F.floor("ratio")).withColumn("p", F.col("ratio") - F.col("whole")).drop("ratio")
    rows = _one_each(rows).withColumn("h", F.xxhash64(F.lit(11), "doc_id", "size", "ordinal"))
    return balanced(stored(rows, "mix-rows")).withColumn("copies", (F.col("whole") + F.col("taken_once")).cast("long"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """doc_id, size (words), source_size, target (words of its source), taken (words the mix takes), copies."""
    none = F.lit(0).cast("long")  # rows of one id, source and size need not be told apart
    out = _drawn(docs, id_col, text_col, source_col, (none, none), weights, share, most)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def _row_hash(docs: DataFrame, seed: int) -> Column:
    """Of all columns. NULLs, which a hash skips, are hashed as flags; nested values as JSON."""
    nested = lambda f: f.dataType.simpleString().startswith(("array", "struct", "map", "variant"))
    cols = [F.to_json(F.struct(F.col(f.name)), {"ignoreNullFields": "false"}) if nested(f) else F.col(f.name) for f in docs.schema]
    return F.xxhash64(F.lit(seed), *cols, F.array(*[F.col(f.name).isNull() for f in docs.schema]))


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, whether or not ids repeat or are null.

    Rows are known by two hashes of all their columns. Of rows that are equal in all columns one stands for all that are taken."""
    columns, keys = docs.columns, ["key1", "key2"]
    drawn = _drawn(docs, id_col, text_col, source_col, (_row_hash(docs, 1), _row_hash(docs, 2)), weights, share, most)
    taken = stored(drawn.groupBy(*keys).agg(F.sum("copies").alias("copies"), F.count("*").alias("n")).where("copies > 0"), "mix-taken")
    rows = docs.select(F.struct(*[F.col(c) for c in columns]).alias("row"), _row_hash(docs, 1).alias("key1"), _row_hash(docs, 2).alias("key2"))
    times = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    out = rows.join(taken.where("n = 1"), keys).withColumn("copy", F.explode(times)).select("row.*")
    repeated = taken.where("n > 1")
    if repeated.isEmpty():
        return out
    # few rows of most tables: a filter of fixed size keeps the others' texts out of the second shuffle
    one = may_hold(rows, "key1", bit_table(repeated, "key1")).groupBy(*keys).agg(F.first("row").alias("row"))
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("copies") / PIECE) - 1))
    spread = one.join(repeated, keys).withColumn("piece", pieces)
    spread = spread.withColumn("copies", F.least(F.lit(PIECE).cast("long"), F.col("copies") - F.col("piece") * PIECE))
    return out.unionByName(spread.withColumn("copy", F.explode(times)).select("row.*"))
