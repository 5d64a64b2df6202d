"""The operators against brute force on small tables and hand-made rows."""

from __future__ import annotations

import base64
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

from entiprof.llm import ann, bpe, fingerprints, linededup, lm, mix, neardup, pii, secrets, toxicity  # noqa: E402
from entiprof.llm.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def documents(spark):
    return dict(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())


def rows(spark, name):
    return {r[0]: r for r in QUERIES[name](spark, SF_SMALL).collect()}


def odd(spark):
    """Null, empty, blank and long texts, repeated rows, and columns that clash with the operators' own."""
    made = [(1, None, "a"), (2, "", None), (3, " \n\t", "a"), (4, "x" * 5000, "b"), (5, "a b c", "b"), (5, "a b c", "b"), (6, "a B c", "é")]
    made += [(7, "call +1 (555) 123-4567 or 4111 1111 1111 1111 é me@x.org 10.0.0.300 10.0.0.1", None), (8, "word " * 400, "b")]
    return spark.createDataFrame([(i, t, s, 9, "k") for i, t, s in made], "doc_id long, text string, source string, row_id int, hash string")


def test_private_and_secret_spans(spark, documents):
    for name, plain in (("op1_pii", brute.private), ("op5_secrets", brute.secret)):
        got = rows(spark, name)
        assert len(got) == len(documents)
        for k, t in documents.items():
            spans = plain(t or "")
            assert got[k]["base_sha256"] == brute.sha(brute.joined(spans))
            assert set(brute.joined(spans).split(",")) <= {"", *got[k]["spans"].split(",")}


def test_context_discovers_unseen_identifiers(spark):
    seeds = [(i, f"ref {i}x write to mail address: u{i}@host{i}.org now") for i in range(8)]
    docs = spark.createDataFrame([*seeds, (90, "so mail address: someone@intranet now"), (91, "room 12 at nine")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert got[90] == "email:17:33" and got[91] == ""


def test_parts_of_a_credential_report_each_other(spark):
    weak = "Zx81kLmQ09pRtY77uVwA"
    docs = spark.createDataFrame([(1, f"login: build7 then {weak} for https://db.example.org/x"), (2, f"alone {weak} here")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.report(docs).collect()}
    assert [s.split(":")[0] for s in got[1].split(",")] == ["login", "mixed", "endpoint"] and got[2] == ""


def test_parts_meet_at_every_offset(spark):
    made, n = [], 0
    for size in (3, 20, 300, 500, 1300):
        for at in range(0, 1300, 7):
            for gap in (0, 399, 400, 401):
                for order in (1, -1):
                    x, y = (at, at + size), (at + size + gap, at + size + gap + 20)
                    made.append((n, *(x if order == 1 else y), *(y if order == 1 else x), gap))
                    n += 1
    table = spark.createDataFrame(made, "row_id long, s int, e int, s2 int, e2 int, gap int")
    left = table.selectExpr("row_id", "'login' AS kind", "0 AS i", "s", "e")
    got = sorted(r.row_id for r in secrets._near(left, table.selectExpr("row_id", "s2 AS s", "e2 AS e"), 400).collect())
    assert got == [r[0] for r in made if r[-1] <= 400]


def test_endpoint_longer_than_the_scope(spark):
    url = "https://db.example.org/" + "x" * 900
    docs = spark.createDataFrame([(1, f"{url} login: build7 token=abcdefgh"), (2, f"{'a ' * 200}{url} {'b ' * 150}login: build7 token=abcdefgh")], "doc_id long, text string")
    got = {r.doc_id: sorted(x.split(":")[0] for x in r.spans.split(",")) for r in secrets.report(docs).collect()}
    assert got == {1: ["assign", "endpoint", "login"], 2: ["assign", "endpoint", "login"]}


def contained(a: set, b: set) -> float:
    return len(a & b) / len(a) if a and b else float(a == b)


def test_fingerprints(spark, documents):
    texts = {k: t or "" for k, t in documents.items()}
    got, after = rows(spark, "op2_fingerprints"), brute.edited(list(texts.items()))
    assert {k: r["edited_sha256"] for k, r in got.items()} == {k: brute.sha(t) for k, t in after.items()}
    order = sorted(texts, reverse=True)
    off = []
    for k, n in zip(order, order[1:] + order[:1]):
        a, b, c = (brute.shingles(t, 5) for t in (texts[k], after[k], texts[n]))
        near = 5 * (1 / max(len(a), 1)) ** 0.5  # five standard deviations of a share among a quarter of the shingles, at most
        for other, column in ((b, "near_edited"), (c, "near_next")):
            assert abs(contained(a, other) - got[k][column]) < near
            off.append(((len(a) + 1) ** 0.5, contained(a, other) - got[k][column]))
    weight, error = np.array(off).T
    assert abs(np.average(error, weights=weight)) < 0.01 and np.average(error**2, weights=weight) ** 0.5 < 0.1


def hashes(fingerprint: str) -> set[int]:
    raw = base64.b64decode(fingerprint)
    return {int.from_bytes(raw[i : i + 6], "big") for i in range(0, len(raw), 6)}


def test_sketches_keep_one_fraction_and_merge(spark):
    draw = random.Random(5)
    made = [(i, " ".join(f"w{draw.randrange(10**9)}" for _ in range(n))) for i, n in enumerate([40, 400, 4000, 40_000, 400_000, 400_000])]
    made += [(6, "a b c d e"), (7, "A b c d e"), (8, "a b"), (9, ""), (10, made[3][1] + " " + made[2][1])]
    got = {r.doc_id: r for r in fingerprints.fingerprint(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    kept = {k: hashes(r.fingerprint) for k, r in got.items()}
    for k, t in made[1:6]:
        n = len(brute.shingles(t, 5))
        assert abs(len(kept[k]) - n / 4) < 5 * (n * 3 / 16) ** 0.5 and max(kept[k]) < 1 << 46, k
    assert got[6].fingerprint == got[7].fingerprint and len(kept[6]) == len(kept[8]) == 1 and got[9].fingerprint == ""
    # a text of two others: their sketches' union, and what the four shingles across the seam add
    assert kept[2] | kept[3] <= kept[10] and len(kept[10] - kept[2] - kept[3]) <= 4


def test_edits_of_an_id_with_a_third_of_the_rows(spark):
    made = [(None, f"null {i} " + "x y " * (i % 9)) for i in range(400)] + [(7, f"seven {i} a b c d") for i in range(400)]
    made += [(i, f"own {i} text of some words") for i in range(-200, 200) if i != 7] + [(None, "twice"), (None, "twice"), (7, None)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("h", F.xxhash64("t")).collect()
    order = sorted(placed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h), reverse=True)
    want = sorted((str(a.doc_id), brute.sha(a.t[: len(a.t) - len(a.t) // 3] + b.t[: len(a.t) // 3])) for a, b in zip(order, order[1:] + order[:1]))
    out = fingerprints.fingerprint_edits(docs).withColumn("task", F.spark_partition_id()).collect()
    assert sorted((str(r.doc_id), r.edited_sha256) for r in out) == want
    assert max(Counter(r.task for r in out).values()) < 2 * len(out) / 8


def test_near_duplicates(spark, documents):
    want = brute.groups(list(documents.items()))
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in rows(spark, "op3_near_duplicates").items()} == want


def test_large_group_of_near_copies(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(120)]
    made = []
    for i in range(120):
        copy = list(words)
        for _ in range(rng.choice([0, 1, 2, 6])):
            copy[rng.randrange(120)] = f"x{rng.random()}"
        made.append((i, " ".join(copy)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    assert got == brute.groups(made)


def test_leftovers_of_large_nodes_meet_in_blocks(spark):
    draw = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    made = []
    for i in range(60):
        words = list(base)
        for _ in range(draw.randrange(6)):
            words[draw.randrange(80)] = f"n{draw.randrange(10**6)}"
        made.append((i, " ".join(words)))
    # one level only: nodes over two documents go straight to the blocks
    got = neardup.near_duplicates(spark.createDataFrame(made, "doc_id long, text string"), small=2, depth=1)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.groups(made)


def test_links_with_unlike_sketches(spark):
    draw, made = random.Random(11), []
    while len(made) < 6:
        a = [f"w{draw.randrange(10**9)}" for _ in range(150)]
        b = [f"n{draw.randrange(10**9)}" if i in (20, 50, 80, 110) else w for i, w in enumerate(a)]  # 136 of 160 shingles: 0.85
        low = []
        for words in (a, b):
            data = np.frombuffer(" ".join(words).encode(), np.uint8)
            (s,) = neardup.shingle_sets(*neardup.row_words(data, np.array([0, len(data)])), 3)
            low.append(neardup._signature(s) & np.uint32(15))
        if (low[0] == low[1]).sum() < 99:  # three standard deviations below the mean
            made += [(len(made), " ".join(a)), (len(made) + 1, " ".join(b))]
    got = neardup.near_duplicates(spark.createDataFrame(made, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.groups(made)


def test_nearest(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in table]), np.array([r[1] for r in table], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got: dict = {}
    for r in QUERIES["op4_nearest"](spark, SF_SMALL).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = x @ x[q]
        s[q] = -9
        hits += len({got[ids[q]][k][0] for k in range(1, 6)} & set(ids[np.lexsort((ids, -s))[:5]]))
    assert hits >= 0.9 * 5 * len(got)


def test_nearest_of_odd_vectors(spark):
    made = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0, None]), (6, [1.0, 1.0]), (7, [1.0, 0.0])]
    v = spark.createDataFrame(made, "vec_id long, embedding array<double>")
    got = ann.search(v, spark.createDataFrame([(0,), (3,)], "query_id long")).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 7), (0, 3, 6)]


def test_nearest_of_very_large_and_small_vectors(spark):
    made = [(0, [1e200, 1e200]), (1, [1.0, 1.0]), (2, [1e-200, 0.0]), (3, [3.0, 1.0]), (4, [-1e300, 1e-300]), (5, [5e-324, 0.0])]
    v = spark.createDataFrame(made, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(v, spark.createDataFrame([(0,), (1,)], "query_id long")).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 6)))
    rest = [(3, 0.894427), (2, 0.707107), (5, 0.707107), (4, -0.707107)]
    assert got == {0: [(1, 1.0), *rest], 1: [(0, 1.0), *rest]}
    empty = v.limit(0)
    assert ann.search(empty, empty.select("vec_id").withColumnRenamed("vec_id", "query_id")).collect() == []
    more = v.withColumn("e", F.lit(1)).withColumn("vid", F.lit("x")).withColumn("s", F.lit(2))
    assert ann.search(more, spark.createDataFrame([(0,)], "query_id long")).count() == 5


def test_language_model_of_odd_texts(spark, monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    # more words than are handed to every task, all as frequent as texts are many
    monkeypatch.setattr(lm, "HEAD", 50)
    many = " ".join(f"w{i}" for i in range(400) for _ in range(2))
    made = [(2, many), (2, many), (None, None), (3, ""), (4, "a  b\n"), (5, "A b c")]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in made], "doc_id long, text string, key string, n int")
    # the plain version goes by id: a row that repeats has an id of its own there
    other = next(i for i in range(100, 200) if brute.crc_mod5(i) == brute.crc_mod5(2))
    want = brute.base_scores([made[0], (other, many), *made[2:]])
    key = lambda r: (r.doc_id is not None, r.doc_id or 0)
    for layout in (docs.repartition(1), docs.repartition(5)):
        got = sorted(lm.score_texts(layout, path).collect(), key=key)
        assert len(got) == len(made)
        for r in got:
            n, known, total, base = want[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and abs(r.base_score - base) < 1e-9 * abs(base)
    assert lm.score_texts(docs.limit(0), path).collect() == []


def test_language_model_does_not_depend_on_the_layout(spark):
    import public_tokenizers

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    one, five = ({r.doc_id: r.score for r in lm.score_texts(docs.repartition(n), public_tokenizers.path("byte_bpe_50k.json")).collect()} for n in (1, 5))
    assert all(abs(one[k] - five[k]) <= 1e-4 * abs(one[k]) for k in one)


def test_scores_follow_from_the_weights():
    rng = np.random.default_rng(3)
    pairs = np.arange(0, lm.V * lm.V, 97)
    counted = lm.Counted(pairs, rng.integers(1, 50, len(pairs)))
    p = {n: (0.2 * rng.normal(size=s)).astype(np.float32) for n, s in lm.SHAPES.items()}
    ids, first = rng.integers(0, lm.V, 60).astype(np.int16), np.array([0, 41, 60])
    x, valid, y, _ = lm.windows(ids, first)
    got, before = lm.log_probabilities(p, counted, x, valid, y), lm.previous(ids, first)
    scored = 0
    for w in range(len(x)):
        for j in range(lm.STRIDE):
            at = lm.WINDOW - lm.STRIDE + j
            if not valid[w, at]:
                continue
            q, s = p["q"][x[w, at]] + p["pq"][j], []
            seen = [i for i in range(at + 1) if valid[w, i]]
            s = np.array([q @ (p["k"][x[w, i]] + p["pk"][i]) * lm.DIM**-0.5 for i in seen])
            a = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
            z = sum(a[n] * p["v"][x[w, i]] for n, i in enumerate(seen)) @ p["o"] + counted.log_class[x[w, at]]
            c = counted.of[y[w, j]]
            want = z[c] - z.max() - np.log(np.exp(z - z.max()).sum()) + counted.within[x[w, at], y[w, j]]
            assert abs(got[w, j] - want) < 1e-4
            scored += 1
    assert scored == len(ids) and len(before) == len(ids)


def test_language_model_base(spark, documents):
    got = rows(spark, "op7_lm")
    for k, (n, known, total, base) in brute.base_scores(list(documents.items())).items():
        r = got[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) and abs(r["base_score"] - base) < 1e-6 * abs(base)
        assert r["score"] < 0


def test_line_dedup(spark, documents):
    want, off = brute.first_runs(list(documents.items()), 50), 0
    for k, r in rows(spark, "op8_line_dedup").items():
        off += abs(r["n_removed"] - len(want[k]))
    # a run is matched with its first occurrences only
    assert off <= 0.002 * sum(map(len, want.values())) + 5


def test_passage_inside_lines(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"one {passage} two\nx"), (2, f"three four\nfive {passage} six"), (3, "three four")], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.text) for r in linededup.dedup_lines(docs).collect()}
    assert got == {1: (0, f"one {passage} two\nx"), 2: (60, "three four\nfive six"), 3: (0, "three four")}


def test_passages_of_which_earlier_texts_hold_parts(spark):
    draw, made, n = random.Random(7), [], 0
    for size, parts in ((55, [(0, 41), (15, 55)]), (60, [(0, 45), (15, 60)]), (50, [(0, 35)]), (130, [(0, 49), (40, 89), (80, 129)])):
        for _ in range(8):
            passage = [f"p{n}_{i}" for i in range(size)]
            around = lambda: [f"x{draw.randrange(10**9)}" for _ in range(draw.randrange(40))]
            for x in [*(passage[a:b] for a, b in parts), passage, passage]:
                made.append((len(made), " ".join([*around(), *x, *around()])))
            made.append((len(made), " ".join([*passage[:30], *around(), *passage, *around(), *passage[5:]])))
            n += 1
    want = {k: len(v) for k, v in brute.first_runs(made, 50).items()}
    assert {r.doc_id: r.n_removed for r in linededup.dedup_lines(spark.createDataFrame(made, "doc_id long, text string")).collect()} == want


def test_line_dedup_misses_no_run(spark, documents):
    want = {k: len(v) for k, v in brute.first_runs(list(documents.items()), 50).items()}
    assert {k: r["n_removed"] for k, r in rows(spark, "op8_line_dedup").items()} == want


def test_bpe(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(5)
    made = list(documents.items())[:40] + [(1000, None), (1001, "<|endoftext|>A's ΣΑΣ \x1c\x85İ²½ 日本"), (1002, "ab" * 3000)]
    made += [(2000 + i, "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), rng.randrange(0x1F300, 0x1F6FF)])) for _ in range(60))) for i in range(40)]
    got = {r.doc_id: r for r in bpe.encode(spark.createDataFrame(made, "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json")).collect()}
    for k, text in made:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[k].ids, "<u4").tolist() == ids and got[k].decoded == t.decode(ids, skip_special_tokens=False)


def test_bpe_of_every_code_point_between_letters():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t, codec = Tokenizer.from_file(path), bpe.Codec(bpe.load(path))
    made = [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    made = [" ".join(made[i : i + 16]) for i in range(0, len(made), 16)]
    for i in range(0, len(made), 4000):
        want = [e.ids for e in t.encode_batch(made[i : i + 4000], add_special_tokens=False)]
        assert [np.frombuffer(b"".join(p[0] for p in d), "<u4").tolist() for d in codec.encode(made[i : i + 4000])] == want


def test_trees_of_many_words_equal_each_alone():
    import public_tokenizers

    v, rng = bpe.load(public_tokenizers.path("word_bpe_49k.json")), np.random.default_rng(6)
    for n in (1, 2, 3, 4, 5, 9, 17, 64):
        words = rng.choice(np.frombuffer(b"aabbeehnorst", np.uint8), (50, n))
        symbols = v.inner[words]
        ids, count = bpe.merge_together(symbols.copy(), v)
        alone = [bpe.merge(s.tolist(), v) for s in symbols]
        assert ids.tolist() == sum(alone, []) and count.tolist() == [len(a) for a in alone]


def test_bpe_forgets_words_and_cuts_long_texts(spark, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(4)
    made = [" ".join(rng.choice(["alpha", "Beta's", "γάμμα", "delta42", "x" * 80, "<|endoftext|>"]) for _ in range(30)) for _ in range(40)]
    made.append("long word" * 300_000)
    t, codec = Tokenizer.from_file(path), bpe.Codec(bpe.load(path))
    for text in made:
        (parts,) = codec.encode([text])
        assert np.frombuffer(b"".join(p[0] for p in parts), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
        assert len(codec.young) <= 6 + 3


def test_mix(spark, documents):
    a, b = rows(spark, "op10_mix"), rows(spark, "op10_mix")
    assert a == b
    assert all(r["size"] == len(brute.WORD.findall(documents[k] or "")) and r["taken"] in (0, r["size"], 2 * r["size"]) for k, r in a.items())
    source = dict(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source").collect())
    sizes = Counter()
    for k, r in a.items():
        sizes[source[k]] += r["size"]
    goal = brute.targets(sizes)
    assert all(r["source_size"] == sizes[source[k]] and r["target"] == pytest.approx(goal[source[k]]) for k, r in a.items())
    for s in sizes:
        assert abs(sum(r["taken"] for k, r in a.items() if source[k] == s) - goal[s]) <= max(r["size"] for k, r in a.items() if source[k] == s)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, None: 1000}, {"z": 5, "é": 0, "": 7}, {None: 3}, {f"host{i}": i * i % 97 for i in range(300)}])
def test_targets(spark, sizes):
    got = mix.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r.source: r.target for r in got} == pytest.approx(brute.targets(sizes), abs=1e-6)
    assert [r.source for r in sorted(got, key=lambda r: r.source_key)] == sorted(sizes, key=lambda s: (s is None, s or ""))


def test_mix_of_repeated_rows(spark, monkeypatch):
    """Three quarters of the rows are equal, others share an id or have none; blocks are small and even, targets are met by rows."""
    monkeypatch.setattr(mix, "BLOCK", 64)
    monkeypatch.setattr(mix, "PIECE", 100)
    made = [(1, "a b c d", "a", None)] * 900 + [(None, "w " * (1 + i % 30), "b", "t") for i in range(300)] + [(2, f"x y {i}", "c", None) for i in range(200)]
    made += [(i, "u " * (i % 50), "c", None) for i in range(3, 300)]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string, extra string")
    sizes = Counter()
    for _, t, s, _ in made:
        sizes[s] += len(t.split())
    goal, blocks = brute.targets(sizes), []
    decide = mix._decide
    monkeypatch.setattr(mix, "_decide", lambda df, last: blocks.append(df.groupBy("source_key", "block").count()) or decide(df, last))
    once = mix.mix_sources(docs).collect()
    assert max(r["count"] for r in blocks[0].collect()) < 2 * 64 and len(once) == len(made)
    assert sorted(once, key=str) == sorted(mix.mix_sources(docs.repartition(3)).collect(), key=str)
    taken = Counter()
    for r in mix.mixed(docs).collect():
        taken[r.source] += len(r.text.split())
    kept, have = Counter(map(tuple, mix.mixed(docs).collect())), Counter(made)
    assert all(n <= 2 * have[r] for r, n in kept.items())
    for s, n in goal.items():
        assert abs(taken[s] - n) <= 50, s
    assert abs(sum(r.taken for r in once) - sum(goal.values())) <= 150


def test_toxicity(spark):
    rng = random.Random(9)
    text = lambda bad: " ".join(rng.choice("abcdefghij") * 3 for _ in range(30)) + (" vile" if bad else "")
    made = [(i, text(i % 4 == 0)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(1, None)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(spark.createDataFrame([*made, (None, None)], "doc_id long, text string"), labels).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) and r.held_out == (brute.crc_mod5(r.doc_id) == 0) for r in got if r.doc_id is not None)
    none = toxicity.score_toxicity(spark.createDataFrame(made[:3], "doc_id long, text string"), labels.limit(0)).collect()
    assert [r.predicted for r in none] == [0, 0, 0]


@pytest.mark.parametrize("name", ["pii", "secrets", "prints", "near", "lines", "mix", "bpe"])
def test_odd_and_empty_tables(spark, name):
    import public_tokenizers

    run = {
        "pii": pii.report, "secrets": secrets.report, "prints": fingerprints.fingerprint_edits, "near": neardup.near_duplicates,
        "lines": linededup.dedup_lines, "mix": mix.mix_sources, "bpe": lambda d: bpe.encode_digests(d, public_tokenizers.path("word_bpe_49k.json")),
    }[name]
    docs = odd(spark)
    assert run(docs).count() == docs.count()
    assert run(docs.limit(0)).count() == 0


def test_every_training_window_is_learned_from(spark):
    """All windows of the training texts are gathered, and packed so that what is learned from stays the same."""
    import public_tokenizers

    rng = np.random.default_rng(4)
    ids, first = rng.integers(0, lm.V, 400).astype(np.int16), np.array([0, 1, 17, 33, 60, 400])
    x, valid, y, _ = lm.windows(ids, first)
    x2, valid2, y2 = lm.unpack(lm.pack(x, valid, y).tobytes())
    live = valid[:, lm.WINDOW - lm.STRIDE :]
    assert (valid == valid2).all() and (x == x2)[valid].all() and (y == y2)[live].all()
    docs = spark.createDataFrame([(1, "one two three " * 40), (2, ""), (None, "four"), (2, "five six")], "doc_id long, text string")
    spec = lm.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    got = lm._gather(docs, spec).where("what = 2")
    raw = [r.text.encode() for r in docs.collect()]
    _, _, ids, first = lm.Subwords(spec).encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert got.count() == len(lm.windows(ids, first)[0]) > 10
    assert sum(int(lm.unpack(r.payload)[1][:, lm.WINDOW - lm.STRIDE :].sum()) for r in got.collect()) == len(ids)
