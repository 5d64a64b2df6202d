"""Cross-tokenizer alignment by products of incidence matrices in hand-built CSR.

Of a block of texts, matrix A has a row per token of the first tokenizer and a
column per byte, B likewise for the second. Gustavson's row products of A and the
transpose of B give the overlap links: which tokens share bytes. Two neighbouring
rows without a common column stand at a byte where tokens of both end, so the
overlap links cut the tokens into groups. Of the tokens' ids, X has a row per
document and id and a column per group, Y a row per group and a column per id:
their product gives the shared-group links of a document as pairs of ids with
their number.

A block is the texts of one or two megabytes (a longer text is a block by itself).
Its distinct id pairs go into the count of documents that hold a pair; what
comes back are the counts of the block's pairs, one row a block, so neither a
frequent pair nor a long text makes a large group. Two stored tables cut the
lineage; that of blocks has row groups of few blocks, since writing and reading hold a
row group whole.

Null and empty texts, and texts whose joined token bytes differ from space and text in
one of the tokenizers, have no tokens: zeros and an empty string. Each row counts
as a document, repeated rows too. An empty table gives an empty one; other columns,
of whatever name, are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiprof.llm.bpe import byte_symbols
from entiprof.llm.common import give_back, row_slices, ship, stored, texts

#: Bytes of text in a block, about; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: Row groups of the stored blocks: a block has some megabytes, and Parquet else looks at the size of 100 rows first.
FEW_BLOCKS = {"parquet.block.row.count.limit": "8", "parquet.block.size": str(1 << 22), "parquet.page.size.row.check.min": "1"}
#: Entries that a row product expands at once.
EXPANDED = 1 << 21


class Csr(NamedTuple):
    """A sparse matrix: row i holds ``indices[indptr[i]:indptr[i + 1]]`` with ``data``, columns ascending."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int


def _bounds(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, .. of counts[0] numbers, then those of starts[1], .."""
    at = _bounds(counts)
    return np.arange(at[-1], dtype=np.int64) + np.repeat(starts - at[:-1], counts)


def _summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of each one's values."""
    if len(key) == 0:
        return key, value
    if not (key[1:] >= key[:-1]).all():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(value, first)


def from_entries(row: np.ndarray, column: np.ndarray, data: np.ndarray, rows: int, columns: int) -> Csr:
    """The matrix of the entries; those of one place are summed."""
    key, total = _summed(row * np.int64(max(1, columns)) + column, data)
    at = key // max(1, columns)
    return Csr(_bounds(np.bincount(at, minlength=rows)), key - at * max(1, columns), total, columns)


def transpose(m: Csr) -> Csr:
    rows = len(m.indptr) - 1
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(m.indptr))
    order = np.argsort(m.indices, kind="stable")
    return Csr(_bounds(np.bincount(m.indices, minlength=m.columns)), row[order], m.data[order], rows)


def product(a: Csr, b: Csr) -> Csr:
    """Gustavson's product: row i is the sum of the rows of ``b`` that row i of ``a`` names, times its data.

    Rows are taken in stretches that expand to about EXPANDED entries.
    """
    rows = len(a.indptr) - 1
    width = np.diff(b.indptr)[a.indices]
    load = _bounds(width)[a.indptr]
    counts, indices, data = np.zeros(rows, np.int64), [], []
    i = 0
    while i < rows:
        j = max(i + 1, int(np.searchsorted(load, load[i] + EXPANDED, "right")) - 1)
        lo, hi = a.indptr[i], a.indptr[j]
        at = _ranges(b.indptr[a.indices[lo:hi]], width[lo:hi])
        row = np.repeat(np.repeat(np.arange(j - i, dtype=np.int64), np.diff(a.indptr[i : j + 1])), width[lo:hi])
        part = from_entries(row, b.indices[at], np.repeat(a.data[lo:hi], width[lo:hi]) * b.data[at], j - i, b.columns)
        counts[i:j] = np.diff(part.indptr)
        indices.append(part.indices)
        data.append(part.data)
        i = j
    empty = np.empty(0, np.int64)
    return Csr(_bounds(counts), np.concatenate(indices or [empty]), np.concatenate(data or [empty]), b.columns)


def byte_incidence(lengths: np.ndarray) -> Csr:
    """A row per token, a column per byte, of tokens that follow each other without a gap."""
    at = _bounds(lengths)
    return Csr(at, np.arange(at[-1], dtype=np.int64), np.ones(at[-1], np.int64), int(at[-1]))


def groups_of(overlap: Csr, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of A and of B, from their overlap links: a group ends where neighbouring rows share nothing."""
    rows = len(overlap.indptr) - 1
    if rows == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first, last = overlap.indices[overlap.indptr[:-1]], overlap.indices[overlap.indptr[1:] - 1]
    ga = np.concatenate([[0], np.cumsum(first[1:] > last[:-1])]).astype(np.int64)
    gb = np.empty(n_b, np.int64)
    gb[overlap.indices] = np.repeat(ga, np.diff(overlap.indptr))
    return ga, gb


class Tokenizers(NamedTuple):
    a: object
    b: object
    a_bytes: list[bytes]
    b_bytes: list[bytes]


@lru_cache(1)
def load(a_path: str, b_path: str) -> Tokenizers:
    """The byte-level BPE file at ``a_path`` and the piece model at ``b_path``, once a worker.

    Where ids follow the order of merges and words are split by the usual pattern, as in
    the file named in the contract, the file is run by tiktoken: the same ids three times
    as fast. Any other file is run by the tokenizers library.
    """
    import sentencepiece

    with open(a_path, encoding="utf-8") as f:
        whole = json.load(f)
    vocab, of = whole["model"]["vocab"], {s: i for i, s in enumerate(byte_symbols())}
    special = {t["id"]: t["content"] for t in whole["added_tokens"]}
    size = max([*vocab.values(), *special]) + 1
    a_bytes = [b""] * size
    for t, i in vocab.items():
        a_bytes[i] = t.encode() if i in special else bytes(map(of.__getitem__, t))
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in whole["model"]["merges"]]
    split = whole["pre_tokenizer"]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and whole["normalizer"] is None
    if plain and not whole["model"].get("ignore_merges") and merged == sorted(merged) and (not merged or merged[0] >= 256):
        import public_tokenizers
        import tiktoken

        ranks = {a_bytes[i]: i for i in vocab.values() if i not in special}
        encoding = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        a = lambda batch: [encoding.encode_ordinary(t) for t in batch]
    else:
        from tokenizers import Tokenizer

        fast = Tokenizer.from_file(a_path)
        fast.encode_special_tokens = True
        fast.no_truncation()
        fast.no_padding()
        a = lambda batch: [fast.encode(t, add_special_tokens=False).ids for t in batch]
    pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes = []
    for i in range(pieces.get_piece_size()):
        p = pieces.id_to_piece(i)
        b_bytes.append(bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode())
    return Tokenizers(a, lambda batch: pieces.encode(batch, num_threads=1), a_bytes, b_bytes)


class Block(NamedTuple):
    """The alignment of some texts. Per text: numbers of tokens, groups and links, the written groups, and its
    links as places in ``pairs`` with their number."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    links: np.ndarray  # bounds, per text, in `pair` and `times`
    pair: np.ndarray
    times: np.ndarray
    pairs: np.ndarray  # distinct: id of A << 32 | id of B


@lru_cache(2)
def _written(size: int) -> np.ndarray:
    """Per id its digits followed by a comma, a bar and a semicolon."""
    return np.array([f"{i}{end}" for i in range(size) for end in ",|;"], object)


def align_block(rows: list[str], t: Tokenizers) -> Block:
    a_ids, b_ids = t.a([" " + x for x in rows]), t.b(rows)
    a_bytes, b_bytes = t.a_bytes, t.b_bytes
    for i, x in enumerate(rows):
        raw = f" {x}".encode()
        if not x or b"".join([a_bytes[k] for k in a_ids[i]]) != raw or b"".join([b_bytes[k] for k in b_ids[i]]) != raw:
            a_ids[i], b_ids[i] = [], []
    n_a, n_b = np.array([len(x) for x in a_ids], np.int64), np.array([len(x) for x in b_ids], np.int64)
    a, b = (np.fromiter((k for x in ids for k in x), np.int64, int(n.sum())) for ids, n in ((a_ids, n_a), (b_ids, n_b)))
    del a_ids, b_ids
    a_len, b_len = (np.array([len(x) for x in table], np.int64) for table in (a_bytes, b_bytes))

    overlap = product(byte_incidence(a_len[a]), transpose(byte_incidence(b_len[b])))
    ga, gb = groups_of(overlap, len(b))
    total = int(ga[-1]) + 1 if len(ga) else 0
    in_a, in_b = np.bincount(ga, minlength=total), np.bincount(gb, minlength=total)
    doc = np.repeat(np.arange(len(rows), dtype=np.int64), n_a)  # of a token of A
    doc_of = np.empty(total, np.int64)
    doc_of[ga] = doc
    n_groups = np.bincount(doc_of, minlength=len(rows))
    n_links = np.zeros(len(rows), np.int64)
    np.add.at(n_links, doc_of, in_a * in_b)

    # group incidence of ids, and its product
    key, row = np.unique(doc << np.int64(32) | a, return_inverse=True)
    x = from_entries(row, ga, np.ones(len(a), np.int64), len(key), total)
    y = from_entries(gb, b, np.ones(len(b), np.int64), total, len(b_bytes))
    linked = product(x, y)
    count = np.diff(linked.indptr)
    pair = np.repeat(key & np.int64(0xFFFFFFFF), count) << np.int64(32) | linked.indices
    pairs, place = np.unique(pair, return_inverse=True)
    links = _bounds(np.bincount(np.repeat(key >> np.int64(32), count), minlength=len(rows)))

    # the groups in writing: of each its A ids, then its B ids
    a_first, b_first = _bounds(in_a), _bounds(in_b)
    words = np.empty(len(a) + len(b), object)
    end = np.zeros(len(a), np.int64)
    end[a_first[1:] - 1] = 1
    words[np.arange(len(a)) + b_first[ga]] = _written(len(a_bytes))[a * 3 + end]
    end = np.zeros(len(b), np.int64)
    end[b_first[1:] - 1] = 2
    words[np.arange(len(b)) + a_first[gb + 1]] = _written(len(b_bytes))[b * 3 + end]
    at = _bounds(n_a + n_b).tolist()
    groups = ["".join(words[i:j].tolist())[:-1] for i, j in zip(at, at[1:])]
    return Block(n_a, n_b, n_groups, n_links, groups, links, place.astype(np.int32), linked.data.astype(np.int32), pairs)


_ROWS = "doc_id array<long>, n_a array<int>, n_b array<int>, n_groups array<int>, n_links array<long>, written array<string>, links array<int>, pair array<int>, times array<int>"


def _blocks(docs: DataFrame, a_path: str, b_path: str, digest: bool) -> DataFrame:
    """A row per block: its number, its texts' alignments, its distinct pairs and in how many of its texts each stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, block = load(a_path, b_path), TaskContext.get().partitionId() << 32
        for whole in batches:
            for rows in row_slices(whole, "text", BLOCK_BYTES):
                b = align_block(rows.column("text").to_pylist(), t)
                written = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in b.groups] if digest else b.groups
                one = [block, rows.column("doc_id").to_pylist(), b.n_a, b.n_b, b.n_groups, b.n_links, written, b.links, b.pair, b.times, b.pairs, np.bincount(b.pair, minlength=len(b.pairs))]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(one, schema)], schema=schema)
                block += 1
            give_back()

    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    types = [pa.int64(), longs, ints, ints, ints, longs, pa.list_(pa.string()), ints, ints, ints, longs, ints]
    names = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "written", "links", "pair", "times", "pairs", "held"]
    schema = pa.schema(list(zip(names, types)))
    return docs.mapInArrow(run, f"block long, {_ROWS}, pairs array<long>, held array<int>")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, n (documents that hold it), best (no pair of the same id of A has more)."""
    held = blocks.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.held").cast("long").alias("held"))
    counts = stored(held.groupBy("pair").agg(F.sum("held").alias("n")).withColumn("a_id", F.shiftright("pair", 32)), "align-pairs")
    most = counts.groupBy("a_id").agg(F.max("n").alias("most"))
    return counts.join(most, "a_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, digest: bool) -> DataFrame:
    ship(docs.sparkSession)
    blocks = stored(_blocks(texts(docs, id_col, text_col), a_path, b_path, digest), "align-blocks", **FEW_BLOCKS)
    places = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    counted = places.join(pair_counts(blocks), "pair").groupBy("block").agg(F.collect_list(F.struct("place", "n", "best")).alias("counted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(whole.num_rows):
                row = {name: whole.column(name)[i].values for name in whole.schema.names if name not in ("block", "counted")}
                found = whole.column("counted")[i].values
                at = row["links"].to_numpy()
                n, best = np.zeros(0, np.int64), np.zeros(0, bool)
                if found is not None:
                    place = found.field("place").to_numpy()
                    n, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
                    n[place] = found.field("n").to_numpy()
                    best[place] = found.field("best").to_numpy(zero_copy_only=False)
                pair, times = row["pair"].to_numpy(), row["times"].to_numpy().astype(np.int64)
                sums = [np.diff(_bounds(v)[at]) for v in (times * best[pair], times * n[pair])]
                columns = [row["doc_id"], *(row[c].cast(pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), *map(pa.array, sums), row["written"]]
                yield pa.RecordBatch.from_arrays(columns, names)
            give_back()

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256" if digest else "groups"]
    schema = ", ".join(f"{c} {'string' if c.startswith('groups') else 'long'}" for c in names)
    rows = blocks.drop("pairs", "held").join(counted, "block", "left")
    return rows.mapInArrow(run, schema)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (``a1,a2|b1;a3|b2,b3``) of every whole text."""
    return _aligned(docs, a_path, b_path, id_col, text_col, digest=False)


def align_digests(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`align` with groups_sha256 in place of the groups; empty where there are none."""
    return _aligned(docs, a_path, b_path, id_col, text_col, digest=True)
