"""Cross-tokenizer alignment against a plain version: byte offsets as sets, links one by one."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from conftest import SF_SMALL
from tokenizers import Tokenizer

from entiprof.llm import align
from entiprof.llm.bpe import byte_symbols
from entiprof.llm.queries import QUERIES

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(docs):
    """Per row the contract's values, and the written groups."""
    a_model, b_model = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a_model.encode_special_tokens = True
    byte = {s: i for i, s in enumerate(byte_symbols())}
    name = {i: s for s, i in json.load(open(A_PATH))["model"]["vocab"].items()}

    def b_bytes(i):
        p = b_model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()

    rows, held = [], Counter()
    for doc_id, text in docs:
        groups, raw = [], (" " + (text or "")).encode()
        if text:
            a = [(i, bytes(byte[c] for c in name[i])) for i in a_model.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, b_bytes(i)) for i in b_model.encode(text)]
            if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
                ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
                cuts = sorted(ends[0] & ends[1])
                groups = [([], []) for _ in cuts]
                for k, side in enumerate((a, b)):
                    at = g = 0
                    for i, x in side:
                        groups[g][k].append(i)
                        at += len(x)
                        g += at == cuts[g]
        links = Counter((x, y) for p, q in groups for x in p for y in q)
        held.update(links.keys())
        rows.append((doc_id, groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, groups, links in rows:
        written = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        best = sum(n for p, n in links.items() if held[p] == most[p[0]])
        out.append((doc_id, sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), sum(links.values()), best, sum(n * held[p] for p, n in links.items()), written))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[-1]))


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in plain(docs)]
    got = QUERIES["op13_align"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert order(got.collect()) == order(want) and sum(r[1] > 0 for r in want) > 150


def test_odd_texts(spark, monkeypatch):
    rng = random.Random(2)
    draw = lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), rng.randrange(0x4E00, 0x9FFF), rng.randrange(0x1F300, 0x1F6FF)]))
    made = [(None, "the cat"), (None, None), (1, ""), (2, "  two  blanks\n\tand a tab"), (3, "<|endoftext|> <s> </s> <unk>"), (4, "日本語のテキスト"), (4, "日本語のテキスト"), (5, "\x00\x01 a▁b ½ﬁ"), (6, "a" * 3001), (7, "word " * 3000)]
    made += [(100 + i, "".join(draw() for _ in range(rng.randrange(50)))) for i in range(60)]
    made += [(200 + i, " ".join(rng.choice(["alpha", "betamax", "Straße", "naïve", "xq7"]) for _ in range(20))) for i in range(60)]
    docs = spark.createDataFrame([(k, t, 3, 4) for k, t in made], "doc_id long, text string, block int, pair int")
    want = order(plain(made))
    for size in (1, 1 << 20):  # a text a block, and all in few
        monkeypatch.setattr(align, "BLOCK_BYTES", size)
        assert order(align.align(docs, A_PATH, B_PATH).collect()) == want
    assert align.align_digests(docs.limit(0), A_PATH, B_PATH).collect() == []


@pytest.mark.parametrize("expanded", [1, 7, 1 << 20])
def test_products(monkeypatch, expanded):
    monkeypatch.setattr(align, "EXPANDED", expanded)
    rng = np.random.default_rng(4)
    for rows, inner, columns in ((0, 3, 2), (4, 0, 5), (9, 6, 8), (30, 20, 25)):
        x, y = rng.integers(0, 3, (rows, inner)) * rng.integers(0, 2, (rows, inner)), rng.integers(0, 3, (inner, columns))
        sparse = [align.from_entries(*(i.astype(np.int64) for i in np.nonzero(m)), m[np.nonzero(m)], *m.shape) for m in (x, y)]
        got = np.zeros((rows, columns), np.int64)
        p = align.product(*sparse)
        for i in range(rows):
            got[i, p.indices[p.indptr[i] : p.indptr[i + 1]]] = p.data[p.indptr[i] : p.indptr[i + 1]]
        assert (got == x @ y).all()
        back = align.transpose(align.transpose(sparse[1]))
        assert all((u == v).all() for u, v in zip(back[:3], sparse[1][:3]))


def test_stored_blocks_stand_in_small_row_groups(spark, monkeypatch, tmp_path):
    """Writing and reading hold a row group whole, so it must not grow with the blocks of a task."""
    made, stored = {}, align.stored

    def kept(df, name, **options):
        made[name] = stored(df, name, **options)
        return made[name]

    monkeypatch.setattr(align, "stored", kept)
    monkeypatch.setattr(align, "BLOCK_BYTES", 1)  # a text a block
    docs = spark.range(0, 150, 1, 1).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    assert align.align(docs, A_PATH, B_PATH).count() == 150
    found = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in made["align-blocks"].inputFiles()]
    groups = [m.row_group(i).num_rows for m in found for i in range(m.num_row_groups)]
    assert sum(groups) == 150 and max(groups) <= 8
    # by size too: three rows of 3 MB of noise are more than a row group holds
    noise = spark.range(0, 3, 1, 1).selectExpr("id", "transform(sequence(1, 400000), i -> xxhash64(id, i)) AS x")
    files = stored(noise, "noise", **align.FEW_BLOCKS).inputFiles()
    assert sum(pq.ParquetFile(f.removeprefix("file://")).metadata.num_row_groups for f in files) > 1
