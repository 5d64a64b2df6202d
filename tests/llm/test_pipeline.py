"""The pipeline's stages and the whole run against brute force on hand-made rows."""

from __future__ import annotations

import random
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra array<int>"


def made() -> list[tuple]:
    """Clean and toxic documents, copies, near copies, passages in others, a null text, a repeated row."""
    draw = random.Random(5)
    words = lambda n: [f"{draw.choice('abcdefghij') * 3}{draw.randrange(10**6)}" for _ in range(n)]
    texts = [" ".join([*words(60), *(["vile"] if i % 4 == 0 else [])]) for i in range(240)]
    passage = words(55)
    texts += [" ".join([*words(40), *passage, *words(40)]) for _ in range(3)]
    for _ in range(4):
        base = words(100)
        texts += [" ".join(base), " ".join(w if i not in (33, 66) else "changed" for i, w in enumerate(base))]
    texts += [texts[1], "  ", None, texts[241].split(" ", 1)[1]]
    out = [(i, t, "en", "abc"[i % 3], len(t or ""), [i]) for i, t in enumerate(texts)]
    return [*out, out[5], (len(out), texts[2], None, None, 1, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(made(), SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def clean(rows):
    return [r for r in rows if "vile" not in (r[1] or "")]


def without_runs(rows):
    gone, out = brute.first_runs(list({r[0]: r[1] for r in rows}.items()), 50), []
    for r in rows:
        words = brute.WORD.findall(r[1] or "")
        text = r[1] if not gone[r[0]] else [w for i, w in enumerate(words) if i not in gone[r[0]]]
        if not gone[r[0]] or text:
            out.append((r[0], text, *r[2:]))
    return out


def first_of_groups(rows):
    kept = {d for d, (_, least) in brute.groups(list({r[0]: r[1] for r in rows}.items()), 80, 5).items() if d == least}
    return [r for r in rows if r[0] in kept]


def counted(rows):
    return Counter(repr(tuple(r)) for r in rows)


def test_toxicity_stage(spark, folder):
    got = STAGES["toxicity"](spark, spark.createDataFrame(made(), SCHEMA), folder)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra"] and counted(got.collect()) == counted(clean(made()))


def test_line_dedup_stage(spark, folder):
    want = without_runs(made())
    got = STAGES["line_dedup"](spark, spark.createDataFrame(made(), SCHEMA), folder).collect()
    split = lambda t: None if t is None else tuple(brute.WORD.findall(t if isinstance(t, str) else " ".join(t)))
    assert counted((r[0], split(r[1]), r[2], r[3], r[5]) for r in got) == counted((r[0], split(r[1]), r[2], r[3], r[5]) for r in want)
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in got)


def test_near_dedup_stage(spark, folder):
    got = STAGES["near_dedup"](spark, spark.createDataFrame(made(), SCHEMA), folder).collect()
    assert counted(got) == counted(first_of_groups(made()))


def test_mix_stage(spark, folder):
    rows = list({r[0]: r for r in made()}.values())
    docs = spark.createDataFrame(rows, SCHEMA)
    got = STAGES["mix"](spark, docs, folder).collect()
    size = {r[0]: len(brute.WORD.findall(r[1] or "")) for r in rows}
    assert set(counted(got)) <= set(counted(rows)) and max(counted(got).values()) <= 2
    goal = brute.targets({s: sum(size[r[0]] for r in rows if r[3] == s) for s in {r[3] for r in rows}})
    for s, n in goal.items():
        assert abs(sum(size[r.doc_id] for r in got if r.source == s) - n) <= max(size[r[0]] for r in rows if r[3] == s)


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    rows = first_of_groups([(r[0], " ".join(r[1]) if isinstance(r[1], list) else r[1], *r[2:]) for r in without_runs(clean(made()))])
    mixed = STAGES["mix"](spark, spark.createDataFrame(rows, SCHEMA), folder).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in mixed)
    text = {r[0]: r[1] or "" for r in rows}
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    plain = {k: brute.WORD.findall(t.decode(t.encode(x, add_special_tokens=False).ids, skip_special_tokens=False)) for k, x in text.items()}
    assert {r.doc_id: brute.WORD.findall(r.decoded) for r in got} == {r.doc_id: plain[r.doc_id] for r in got}


def test_empty_table(spark, folder):
    none = spark.createDataFrame([], SCHEMA)
    for stage in STAGES.values():
        assert stage(spark, none, folder).count() == 0
