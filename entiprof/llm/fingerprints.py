"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below one fixed fraction of the hash range, a
quarter, whatever the document's length, so sketches of any two documents (and
their union, the sketch of both) estimate how much of one is contained in the other,
however unequal their lengths. Where no hash is below it, which happens to texts of a few
words, the smallest hash stands alone; it too can be merged, as the smaller of two.

Null text is empty: no words, an empty sketch. Equal fingerprints, empty ones
included, are alike by 1; an empty sketch is unlike any other (0). An empty table
gives no rows; repeated rows are documents of their own; columns other than id and
text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiprof.llm.common import text_blocks, texts
from entiprof.llm.words import row_words, shingle_sets

SHINGLE = 5
#: Hashes below 2**(48 - FRACTION) stay.
FRACTION = 2
_LIMIT = np.uint64(1 << (48 - FRACTION))


class Sketch:
    """Sorted 48-bit hashes below the limit, or the smallest."""

    __slots__ = ("hashes",)

    def __init__(self, shingles: np.ndarray):
        h = shingles >> np.uint64(16)
        low = h[h < _LIMIT]
        self.hashes = np.unique(low if len(low) else h.min(keepdims=True) if len(h) else h)

    def text(self) -> str:
        packed = self.hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
        return base64.b64encode(packed.tobytes()).decode()

    def contained_in(self, other: Sketch) -> float:
        a, b = self.hashes, other.hashes
        if len(a) == 0 or len(b) == 0:
            return float(len(a) == len(b))
        at = np.searchsorted(b, a)
        return float(np.mean(b[np.minimum(at, len(b) - 1)] == a))


def sketches(batch: pa.RecordBatch, column: str = "text") -> list[Sketch]:
    """Of lower-cased words, SHINGLE at a time."""
    out: list[Sketch] = []
    for _, _, data, bounds in text_blocks(batch, column):
        out += [Sketch(s) for s in shingle_sets(*row_words(data, bounds), SHINGLE)]
    return out


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chars = [len(t) for t in b.column("text").to_pylist()]
            prints = [s.text() for s in sketches(b)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(chars, pa.int64()), pa.array(prints, pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


_LOWEST = -(1 << 63)


#: Order of the documents: by id, and by a hash of the text where an id has many rows.
_PLACE = np.dtype([("k", np.int64), ("h", np.int64)])


def _places(k: np.ndarray, h: np.ndarray) -> np.ndarray:
    out = np.empty(len(k), _PLACE)
    out["k"], out["h"] = k, h
    return out


def _cuts(ids: DataFrame, n: int) -> tuple[np.ndarray, list[int]]:
    """Places that cut the documents into about ``n`` ranges, and the ids that have ranges of their own.

    An id with the rows of several ranges stands several times among the quantiles; its rows
    are cut by their texts' hashes instead, into as many ranges."""
    if n < 2:
        return np.empty(0, _PLACE), []
    found = ids.agg(F.percentile_approx("k", [i / n for i in range(1, n)], max(10_000, 20 * n)).alias("cuts")).first()["cuts"]
    values, times = np.unique(np.array(found or [], np.int64), return_counts=True)
    places, heavy = [], []
    for v, m in zip(values.tolist(), times.tolist()):
        places.append((v, _LOWEST))
        if m > 1:
            heavy.append(v)
            places += [(v, _LOWEST + (1 << 64) // m * i) for i in range(1, m)]
    return np.array(places, _PLACE), heavy


def _chained(docs: DataFrame) -> DataFrame:
    """The documents in ranges of their place, one range a partition, each in descending order and followed by a
    copy of the next range's first document, so that a task sees every document's successor."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce("doc_id", F.lit(_LOWEST))
    cuts, heavy = _cuts(docs.select(key.alias("k")), n)
    # texts are hashed for the ids that need it only
    by_text = F.when(key.isin(heavy), F.xxhash64("text")).otherwise(F.lit(0).cast("long")) if heavy else F.lit(0).cast("long")
    ids = docs.select(key.alias("k"), by_text.alias("h"))

    @F.pandas_udf("int")
    def bucket(k: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, _places(k.to_numpy(np.int64), h.to_numpy(np.int64)), "right").astype(np.int32))

    firsts = ids.groupBy(bucket("k", "h").alias("b")).agg(F.max(F.struct("k", "h")).alias("top")).collect()
    tops = sorted((r["b"], tuple(r["top"])) for r in firsts)
    # the first document of each range also ends the range above it; the very first ends the lowest
    heir = {place: tops[(i + 1) % len(tops)][0] for i, (_, place) in enumerate(tops)}
    heads, above = np.array(sorted(heir), _PLACE), np.array([heir[p] for p in sorted(heir)], np.int32)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            place = _places(*(b.column(c).to_numpy(zero_copy_only=False) for c in ("k", "h")))
            at = np.minimum(np.searchsorted(heads, place), len(heads) - 1)
            # of equal rows one copy is enough
            copied = {(at[i], b.column("text")[i].as_py()): i for i in np.flatnonzero(heads[at] == place)}
            copied = np.array(sorted(copied.values()), np.int64)
            order = np.concatenate([np.arange(len(place)), copied])
            part = np.concatenate([np.searchsorted(cuts, place, "right").astype(np.int32), above[at[copied]]])
            is_copy = np.arange(len(order)) >= len(place)
            rows = pa.table([b.column(c) for c in ("doc_id", "text", "k", "h")], ["doc_id", "text", "k", "h"])
            rows = pa.concat_tables([rows, rows.take(pa.array(copied))]) if len(copied) else rows
            yield from rows.append_column("part", pa.array(part)).append_column("is_copy", pa.array(is_copy)).combine_chunks().to_batches()

    keyed = docs.select("doc_id", "text", key.alias("k"), by_text.alias("h"))
    routed = keyed.mapInArrow(route, "doc_id long, text string, k long, h long, part int, is_copy boolean")
    return routed.repartitionById(n, F.pmod("part", F.lit(n))).sortWithinPartitions("part", "is_copy", F.desc("k"), F.desc("h"), "text")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside its edited text: the last third replaced by as much of the next document's start.

    The next document is that of the next smaller id, after the smallest the
    largest; repeated ids follow each other by text (those with more rows than a range by its
    hash first, so that they are many tasks), null ids come last. Rows that are equal in both
    stay in one task. One shuffle moves the texts.
    """
    docs = texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for b in batches:
            rows = [*held, *zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("is_copy").to_pylist(), b.column("part").to_pylist(), sketches(b))]
            held, done, after = rows[-1:], [], []
            for a, n in zip(rows, rows[1:]):
                if not a[2]:
                    third = len(a[1]) // 3
                    done.append(a)
                    after.append((a[1][: len(a[1]) - third] + n[1][:third], n[4]))
            if done:
                edited = pa.array([t for t, _ in after], pa.large_string())
                own = sketches(pa.RecordBatch.from_arrays([edited], ["text"]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([a[0] for a in done], pa.int64()),
                        pa.array([len(a[1]) for a in done], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t, _ in after]),
                        pa.array([a[4].text() for a in done]),
                        pa.array([s.text() for s in own]),
                        pa.array([a[4].contained_in(s) for a, s in zip(done, own)]),
                        pa.array([a[4].contained_in(s) for a, (_, s) in zip(done, after)]),
                    ],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _chained(docs).mapInArrow(run, schema)
