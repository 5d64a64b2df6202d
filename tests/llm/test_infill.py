"""The fill-in-middle transformation against its SQL, a plain version and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest
from conftest import SF_SMALL

from entiprof.llm import infill
from entiprof.llm.queries import ORACLE_SQL, QUERIES

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n, digest = len(units), sha("7:" + ("" if doc_id is None else str(doc_id)))
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or "<P>" in text or "<S>" in text or "<M>" in text:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    out = f"<S>{suf}<P>{pre}<M>{mid}" if h[3] % 100 < 50 else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, "spm" if h[3] % 100 < 50 else "psm", len(pre), len(mid), sha(out), sha(text)


def test_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = QUERIES["op11_infill"](spark, SF_SMALL)
    want = con.execute(ORACLE_SQL["op11_infill"])
    assert got.columns == [d[0] for d in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_odd_texts(spark):
    rng = random.Random(1)
    made = [(None, "a\nb"), (None, None), (1, None), (2, ""), (3, "\n"), (4, "\n\n\nx"), (5, "<P"), (5, "<P"), (6, "a <M> b\nc"), (7, "é😀\n\r\n\x85  \nz<"), (8, "x" * 3_000_000), (9, "ab\n" * 400_000)]
    made += [(100 + i, "".join(rng.choice("ab<>SPM\n😀") for _ in range(rng.randrange(60)))) for i in range(400)]
    docs = spark.createDataFrame([(k, t, 1, "o") for k, t in made], "doc_id long, text string, n int, output string")
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, infill.report(docs).collect()), key=key) == sorted((plain(*d) for d in made), key=key)
    whole = infill.restore(infill.infill(docs, percent=40, spm_percent=10, seed=3))
    assert sorted(r.restored for r in whole.collect()) == sorted(t or "" for _, t in made)
    assert {r.form for r in whole.collect()} == {"plain", "psm", "spm"}
    assert infill.report(docs.limit(0)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 5, 6, 40, 5000])
def test_skip_list(n):
    rng = random.Random(n)
    widths = [rng.randrange(9) for _ in range(n)]
    lanes, total = infill.SkipList(widths), 0
    for rank in range(n + 1):
        assert lanes.chars_before(rank) == total
        total += widths[rank] if rank < n else 0
    assert n < 40 or 2 < len(lanes.lanes) < 20
