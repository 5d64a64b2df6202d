"""Helpers shared by the operators: stored tables, row text, blocks of Arrow text."""

from __future__ import annotations

import contextlib
import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entiprof.session import ensure_checkpoint_dir

#: Words of the contracts: runs of anything but space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet (``options``: of the writer) into the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor reruns only what stands after this table,
    and values that a rerun could draw anew (row ids) are fixed.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators need, so that no other column can clash; null texts are empty."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def crc_mod5(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where the environment does not: send it with the session."""
    root = Path(__file__).resolve().parents[2]
    sc = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or any("entiprof-src" in f for f in sc.listFiles):
        return
    # only the driver reads this archive; Spark's file service hands it to the executors
    sc.addPyFile(shutil.make_archive(str(Path(tempfile.mkdtemp()) / "entiprof-src"), "zip", root, "entiprof"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_blocks(batch: pa.RecordBatch, column: str = "text", max_bytes: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with about ``max_bytes`` of UTF-8 each: (first row, end row, bytes, row bounds).

    A longer row is a block of its own. Few rows are copied at a time, to keep a task's memory low.
    """
    rows = max(64, max_bytes // 1024)
    for at in range(0, batch.num_rows, rows):
        col = pc.fill_null(batch.column(column).slice(at, rows).cast(pa.large_string()), "")
        n, buffers = len(col), col.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[col.offset : col.offset + n + 1]
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
        lo = 0
        while lo < n:
            hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1))
            yield at + lo, at + hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            lo = hi
    give_back()


def row_slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``max_bytes`` of the column's text; a longer row is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    lo = 0
    while lo < batch.num_rows:
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + max_bytes, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def give_back() -> None:
    """Return freed memory to the system: a reused worker would hold a batch's peak while other tasks run."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def bit_table(ids: DataFrame, column: str, bits: int = 23) -> np.ndarray:
    """A one-hash Bloom filter over a long column, of fixed size (2**bits bits, 1 MB): as packed words.

    It only spares work: rows that pass are joined exactly afterwards.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(1 << bits))
    rows = ids.select(slot.alias("h")).selectExpr("shiftright(h, 6) AS w", "shiftleft(1L, cast(h & 63 AS int)) AS b")
    table = np.zeros(1 << (bits - 6), np.uint64)
    for w, b in rows.groupBy("w").agg(F.bit_or("b")).collect():
        table[w] = np.uint64(b & 0xFFFFFFFFFFFFFFFF)
    return table


def may_hold(docs: DataFrame, key: str, table: np.ndarray, present: bool = True) -> DataFrame:
    """Rows of ``docs`` whose long column ``key`` may be in the filter of :func:`bit_table` (or those that are not)."""
    bits = int(np.log2(len(table))) + 6
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def hit(h: pa.Array) -> pa.Array:
        slot = h.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1) == 1) == present)

    return docs.where(hit(F.pmod(F.xxhash64(key), F.lit(1 << bits))))
