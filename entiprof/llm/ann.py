"""Approximate nearest neighbours by cosine: a hash-prefix forest.

Each tree names a vector by a long string of symbols; a symbol is the nearest
of the 2d signed axes after a random rotation. The entries are dealt to shards of
bounded size; a shard keeps, for each tree, the sorted array of its strings. A
query descends in every tree of a shard to the whole string, then ascends in
all trees at once, a symbol at a time, until the stretches of the sorted arrays
that share its prefix hold enough candidates together. The candidates are compared
where they lie: a shard meets the queries in blocks and returns each query's
best rows, so candidates are never rows of a join, and no vector is copied for
each tree it stands in.

Equal vectors are one entry with its few smallest ids, since others can't be
among the nearest. Rows whose vector is null, zero, of another length than the
table's first or holds null or non-finite components take no part. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entiprof.llm.common import ship, stored

TREES = 64
SYMBOLS = 4
#: Candidates (repeats over trees counted) that a query ascends for in a shard: this many, or this share of its entries.
LEAST, SHARE = 500, 0.125
#: Entries of a shard, and queries of a block, on average.
BLOCK = 4096


@lru_cache(512)
def _rotation(tree: int, symbol: int, d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([9, tree, symbol, d]).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def strings(x: np.ndarray, trees: int) -> np.ndarray:
    """The string of each unit vector (rows of x) in each tree: its symbols as digits of one number."""
    out = np.zeros((len(x), trees), np.int64)
    for tree in range(trees):
        for s in range(SYMBOLS):
            y = x @ _rotation(tree, s, x.shape[1])
            at = np.abs(y).argmax(axis=1)
            out[:, tree] = out[:, tree] * (2 * x.shape[1]) + 2 * at + (y[np.arange(len(x)), at] > 0)
    return out


def _entries(vectors: DataFrame, id_col: str, vector_col: str, per_vector: int, trees: int) -> tuple[DataFrame, int]:
    """(vid, v: doubles as bytes, s: the strings as bytes, ids: the smallest ids), one per distinct vector, and the vectors' length."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("e")).where("id IS NOT NULL AND e IS NOT NULL")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.forall("e", finite) & F.exists("e", lambda x: x != 0))
    first = rows.orderBy("id").select(F.size("e").alias("d")).first()
    d = first["d"] if first else 1
    rows = rows.where(F.size("e") == d)
    # -0.0 equals 0.0
    rows = rows.select("id", F.transform("e", lambda x: x + F.lit(0.0)).alias("e")).distinct()
    best = rows.withColumn("r", F.row_number().over(Window.partitionBy("e").orderBy("id"))).where(F.col("r") <= per_vector)
    entries = best.groupBy("e").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("vid", F.monotonically_increasing_id())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                x = np.asarray(b.column("e").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, d)
                names = strings(x / np.abs(x).max(axis=1, keepdims=True), trees)
                rows = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (x, names)]
                yield pa.RecordBatch.from_arrays([b.column("vid"), *rows, b.column("ids")], ["vid", "v", "s", "ids"])

    return stored(entries.select("vid", "e", "ids").mapInArrow(pack, "vid long, v binary, s binary, ids array<long>"), "ann-entries"), d


def _candidates(order: np.ndarray, arrays: np.ndarray, asked: np.ndarray, base: int, enough: float) -> np.ndarray:
    """For each query string (rows of asked), which entries of a shard its ascent meets.

    ``order``, ``arrays``: per tree (row) the shard's entries by their strings, and these strings.
    """
    met = np.zeros((len(asked), arrays.shape[1]), bool)
    climbing = np.arange(len(asked))
    for level in range(SYMBOLS, 0, -1):
        rest = base ** (SYMBOLS - level)
        prefix = asked[climbing] // rest * rest
        lo, hi = np.empty_like(prefix), np.empty_like(prefix)
        for tree, array in enumerate(arrays):
            lo[:, tree] = np.searchsorted(array, prefix[:, tree])
            hi[:, tree] = np.searchsorted(array, prefix[:, tree] + rest)
        done = (hi - lo).sum(axis=1) >= enough
        for row, starts, ends in zip(climbing[done], lo[done].tolist(), hi[done].tolist()):
            for sorted_entries, start, end in zip(order, starts, ends):
                met[row, sorted_entries[start:end]] = True
        climbing = climbing[~done]
    met[climbing] = True  # the root
    return met


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row by a power of two, so that its largest component lies between 1/2 and 1: squares of
    very large or small components neither overflow nor vanish, and no digit of a cosine changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _best(points: pd.DataFrame, queries: pd.DataFrame, d: int, keep: int, least: int, share: float) -> pd.DataFrame:
    """For each query its ``keep`` best candidates of a shard by cosine, in double precision, ties to the smaller id."""
    unpack = lambda c, kind, n: np.frombuffer(b"".join(c), kind).reshape(-1, n)
    p, q = scaled(unpack(points["v"], np.float64, d)), scaled(unpack(queries["w"], np.float64, d))
    trees = len(points["s"].iloc[0]) // 8
    names, asked = unpack(points["s"], np.int64, trees).T.copy(), unpack(queries["t"], np.int64, trees)
    order = np.argsort(names, axis=1, kind="stable")
    arrays = np.take_along_axis(names, order, axis=1)
    vid, first, qvid = points["vid"].to_numpy(), points["first"].to_numpy(), queries["qvid"].to_numpy()
    pn, qn = np.sqrt(np.einsum("ij,ij->i", p, p)), np.sqrt(np.einsum("ij,ij->i", q, q))
    out = []
    for at in range(0, len(q), 256):
        some = q[at : at + 256]
        near = (some @ p.T) / qn[at : at + 256, None] / pn
        near[~_candidates(order, arrays, asked[at : at + 256], 2 * d, max(least, share * len(p)))] = -np.inf
        last = -np.partition(-near, min(keep, len(p)) - 1, axis=1)[:, min(keep, len(p)) - 1]
        # what rounding may order otherwise comes along
        rows, cols = np.nonzero((near >= last[:, None] - 1e-12) & (near > -np.inf))
        # the same sums whatever block a pair meets in
        score = np.einsum("ij,ij->i", some[rows], p[cols]) / (qn[at + rows] * pn[cols])
        by = np.lexsort((first[cols], -score, rows))
        rows, cols, score = rows[by], cols[by], score[by]
        top = np.arange(len(rows)) - np.searchsorted(rows, rows) < keep
        out.append(pd.DataFrame({"qvid": qvid[at + rows[top]], "vid": vid[cols[top]], "score": score[top]}))
    return pd.concat(out)


def search(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, trees: int = TREES, least: int = LEAST, share: float = SHARE
) -> DataFrame:
    """The k nearest found of each query: query_id, rank, vec_id, score. ``queries``: (query_id), ids of rows of ``vectors``."""
    ship(vectors.sparkSession)
    entries, d = _entries(vectors, id_col, vector_col, k + 1, trees)
    asked = _asked(vectors, queries, entries, id_col, vector_col, d)
    qvids = asked.select("qvid").distinct()
    shards, blocks = math.ceil(max(1, entries.count()) / BLOCK), math.ceil(max(1, qvids.count()) / BLOCK)

    points = entries.select(F.expr(f"pmod(xxhash64(vid, 1), {shards}L)").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vid", "v", "s", F.col("ids")[0].alias("first"))
    asks = qvids.join(entries.select(F.col("vid").alias("qvid"), F.col("v").alias("w"), F.col("s").alias("t")), "qvid")
    asks = asks.select(F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"), F.expr(f"int(pmod(xxhash64(qvid, 2), {blocks}))").alias("block"), "qvid", "w", "t")

    def compare(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        return _best(p, q, d, k + 1, least, share) if len(p) and len(q) else pd.DataFrame({"qvid": [], "vid": [], "score": []})

    best = points.groupBy("shard", "block").cogroup(asks.groupBy("shard", "block")).applyInPandas(compare, "qvid long, vid long, score double")
    # k + 1 entries: one may hold nothing but the query itself
    least_id = best.join(entries.select("vid", "ids"), "vid").withColumn("first", F.col("ids")[0])
    order = Window.partitionBy("qvid").orderBy(F.desc("score"), "first")
    top = least_id.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    answers = top.groupBy("qvid").agg(F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("minus"), i.alias("vec_id")))))).alias("all"))
    mine = asked.join(answers, "qvid").select("query_id", F.slice(F.filter("all", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("found"))
    return mine.select("query_id", F.posexplode("found").alias("rank", "hit")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score")
    )


def _asked(vectors: DataFrame, queries: DataFrame, entries: DataFrame, id_col: str, vector_col: str, d: int) -> DataFrame:
    """(query_id, qvid): the entry of each query's vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("query_id"), F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("e"))
    rows = rows.join(queries.select(F.col("query_id").cast("long")).distinct(), "query_id", "left_semi")

    @F.pandas_udf("binary")
    def packed(e: pd.Series) -> pd.Series:
        return e.map(lambda x: np.asarray(x, np.float64).tobytes() if x is not None else None)

    keyed = rows.withColumn("v", packed("e")).select("query_id", "v")
    return stored(keyed.distinct().join(entries.select("v", F.col("vid").alias("qvid")), "v").select("query_id", "qvid"), "ann-asked")
