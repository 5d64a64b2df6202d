"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its distinct words, word pairs and pairs with one word
skipped, hashed to 64 bits; words are lower-cased runs of letters and digits. One
task learns from a bounded, hash-drawn sample of labelled rows, with
per-coordinate rates and L1 sparsity, over the features that occur in at least
MIN_TEXTS of its texts. The model is a short sorted list of (feature hash,
weight), bounded by the sample, which goes to every task. Texts are scored whole, in blocks.

Null text is empty: its score is that of the bias alone. Null labels are not
learned from; without labels every score is 0.25 and no row is rejected. Other
columns are ignored; repeated rows give one result each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiprof.llm.common import crc_mod5, give_back, text_blocks, texts
from entiprof.llm.words import NOT_ALNUM, U, mix, row_words

#: Labelled rows learned from at most (the smallest hashes of their ids).
SAMPLE = 16_000
MIN_TEXTS = 4
EPOCHS = 3
#: The feature that every text has.
BIAS = U(0)
#: The bias without labels.
_UNKNOWN = -1.0986122886681098


def _features(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature hash) of each word, pair and skipping pair of rows of word hashes; repeats included."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    rows, codes = [row], [h]
    for gap, salt in ((1, 0x1F123BB5159A55E5), (2, 0x52DCE729DA3ED7A5)):
        if len(row) > gap:
            same = row[gap:] == row[:-gap]
            rows.append(row[:-gap][same])
            codes.append(mix(h[:-gap] * U(3) + mix(h[gap:] + U(salt)))[same])
    return np.concatenate(rows), np.concatenate(codes)


class Ftrl:
    """FTRL-proximal: weights are made from the sums z and n when they are read. The last of ``size`` is the bias, not pulled to zero."""

    def __init__(self, size: int, alpha: float = 0.6, beta: float = 1.0, l1: float = 10.0, l2: float = 0.1):
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        self.z, self.n, self.l1 = np.zeros(size), np.zeros(size), np.full(size, l1)
        self.l1[-1] = 0.0

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, pull = self.z[at], self.l1[at]
        rate = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= pull, 0.0, (np.sign(z) * pull - z) / rate)

    def learn(self, at: np.ndarray, label: int, weight: float) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label) * weight
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(batches: list[pa.RecordBatch], labels: np.ndarray, order: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(feature hashes, weights), sorted, from the batches' column ``text``, learned row by row in ``order``."""

    def features() -> Iterator[np.ndarray]:
        for _, _, data, bounds in (block for batch in batches for block in text_blocks(batch)):
            row, code = _features(*row_words(data, bounds, blank=NOT_ALNUM))
            by = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[by], np.arange(len(bounds)))
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield np.unique(code[by[a:b]])

    # most features are rare: a table of counts by hash drops them before any list of features is made
    table = np.zeros(1 << 24, np.uint8)
    for codes in features():
        slot = codes >> U(40)
        table[slot] = np.minimum(table[slot], 250) + 1
    every = [codes[table[codes >> U(40)] >= MIN_TEXTS] for codes in features()]
    del table
    # counted by ranges of the hash, to sort a sixteenth at a time
    kept = []
    for low in range(16):
        edges = np.array([low << 60, (low << 60) + (1 << 60) - 1], U)
        part = [codes[np.searchsorted(codes, edges[0]) : np.searchsorted(codes, edges[1], "right")] for codes in every]
        found, n = np.unique(np.concatenate(part) if part else np.empty(0, U), return_counts=True)
        kept.append(found[(n >= MIN_TEXTS) & (found != BIAS)])
    known = np.concatenate(kept)
    if not len(labels):
        return np.array([BIAS]), np.array([_UNKNOWN])
    bias, places = len(known), []
    every.reverse()
    while every:
        codes = every.pop()
        at = np.minimum(np.searchsorted(known, codes), max(0, bias - 1))
        places.append(np.append(at[known[at] == codes] if bias else at[:0], bias).astype(np.int32))
    model = Ftrl(bias + 1)
    # the rarer label weighs more
    heavy = min(4.0, max(1.0, float((labels == 0).sum()) / max(1, int((labels == 1).sum())) / 2))
    for _ in range(epochs):
        for i in order.tolist():
            model.learn(places[i], labels[i], heavy if labels[i] == 1 else 1.0)
    w = model.weights()
    keep = np.flatnonzero(w[:-1])
    return np.concatenate([[BIAS], known[keep]]), np.concatenate([w[-1:], w[keep]])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """:func:`fit` on ``docs`` (doc_id, text) joined with ``labels`` (doc_id, label: 0 or 1)."""
    h = F.xxhash64(F.lit(5), "doc_id")
    # at most ``sample`` rows of ids and labels: safe to broadcast
    drawn = labels.where("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(h).limit(sample)
    # repeated ids: one text, so that the bound holds
    rows = docs.join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))

    def learn(table: pa.Table) -> pa.Table:
        order = np.argsort(mix(table["doc_id"].to_numpy().view(U)), kind="stable")
        keys, w = fit(table.select(["text"]).to_batches(), table["label"].to_numpy(), order)
        give_back()
        return pa.table({"key": keys.view(np.int64), "w": w})

    out = rows.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(learn, "key long, w double").toArrow()
    if not out.num_rows:
        return np.array([BIAS]), np.array([_UNKNOWN])
    keys, w = out["key"].to_numpy().view(U), out["w"].to_numpy()
    order = np.argsort(keys)
    return keys[order], w[order]


def scorer(spark, model: tuple[np.ndarray, np.ndarray]):
    """A vectorized function: texts to scores."""
    shared = spark.sparkContext.broadcast(model)
    first_bits: list[np.ndarray] = []

    def score(col: pa.Array) -> np.ndarray:
        keys, w = shared.value
        if not first_bits:  # spares most look-ups
            first_bits.append(np.zeros(1 << 20, bool))
            first_bits[0][keys >> U(44)] = True
        out = []
        for _, _, data, bounds in text_blocks(pa.RecordBatch.from_arrays([col], ["text"])):
            row, code = _features(*row_words(data, bounds, blank=NOT_ALNUM))
            maybe = np.flatnonzero(first_bits[0][code >> U(44)])
            row, code = row[maybe], code[maybe]
            at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
            hit = (keys[at] == code) & (code != BIAS)
            pairs = np.unique(row[hit] * len(keys) + at[hit])  # a feature counts once a text
            out.append(np.bincount(pairs // len(keys), w[pairs % len(keys)], len(bounds) - 1) + w[0])
        total = np.concatenate(out) if out else np.empty(0)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))

    return score


def _learned(docs: DataFrame, labels: DataFrame, train_only: bool) -> tuple[np.ndarray, np.ndarray]:
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    return train(docs, labels.where(crc_mod5() != 0) if train_only else labels)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted; learns from labelled rows that are not held out (crc32 of the id modulo 5 is 0)."""
    docs = texts(docs, id_col, text_col)
    score = scorer(docs.sparkSession, _learned(docs, labels, True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", (crc_mod5() == 0).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score below 0.5."""
    score = scorer(docs.sparkSession, _learned(texts(docs, id_col, text_col), labels, True))

    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        return pa.array(score(text), pa.float64())

    return docs.where(scored(F.coalesce(F.col(text_col), F.lit(""))) < 0.5)
