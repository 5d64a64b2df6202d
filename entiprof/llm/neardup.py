"""MinHash near-duplicates by a chosen-path set similarity join.

Documents are sets of word shingles; equal sets are one representative. Each
tree branches the representatives by minwise tokens: a token of a document's
signature is chosen, by a hash of the path so far, with a chance that lets a
pair at the threshold share more than one branch on average. Nodes of a few
documents compare all their pairs; larger ones branch again. The root branches
by set size, since sets of one link differ by a factor of at most 1/threshold.
Independent trees raise the recall (a pair at the threshold is missed with a
chance of 3e-6 where its nodes are small at once, 2e-3 at full depth; closer
pairs less).

Large groups of copies would stay together on every path. So the first level's
large nodes each link their documents to one member (confirmed on full sets);
later, documents already in one component are not compared again, and a node
of a single component ends. Candidates pass a 4-bit minwise sketch inside the
join, then are confirmed on full sets. What is left in large nodes at full depth
meets in pairs of blocks of full sets. No task holds a node's pairs.

Null or blank text has an empty set, linked with nothing; repeated rows give
one result each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiprof.llm.common import bit_table, may_hold, stored, text_blocks, texts
from entiprof.llm.components import components
from entiprof.llm.words import U, mix, row_words, shingle_sets

#: Minwise values of a signature, and of these the bits that the sketch keeps (4 each, in 8 longs).
T = 128
WORDS = 8
_ODD = mix(np.arange(1, T + 1, dtype=U)) | U(1)


def _signature(s: np.ndarray) -> np.ndarray:
    low = np.full(T, np.uint32(0xFFFFFFFF), np.uint32)
    for i in range(0, len(s), 1024):
        low = np.minimum(low, ((s[i : i + 1024, None] * _ODD) >> U(32)).astype(np.uint32).min(axis=0))
    return low


def _key(s: np.ndarray) -> bytes:
    return hashlib.md5(s.tobytes()).digest()


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n_shingles, sid (16 bytes that name the set; null if empty), sig, k0..k7 (the sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sid, sig, sketch = [], [], [], []
            for _, _, data, bounds in text_blocks(b):
                for s in shingle_sets(*row_words(data, bounds), shingle):
                    n.append(len(s))
                    sid.append(_key(s) if len(s) else None)
                    low = _signature(s)
                    sig.append(low.tobytes())
                    four = (low & np.uint32(15)).astype(np.uint8)
                    sketch.append((four[0::2] | four[1::2] << 4).view(np.int64))
            if n:
                cols = list(np.array(sketch).reshape(-1, WORDS).T)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(sid, pa.binary()), pa.array(sig, pa.binary()), *[pa.array(np.ascontiguousarray(c)) for c in cols]],
                    ["doc_id", "n_shingles", "sid", "sig", *[f"k{i}" for i in range(WORDS)]],
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, sid binary, sig binary, " + ", ".join(f"k{i} long" for i in range(WORDS)))


def _children(node: np.ndarray, values: np.ndarray, chance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows with paths ``node`` and signatures ``values``: (row, token place, child path) of the tokens chosen."""
    h = mix(values.astype(U) * U(T) + np.arange(T, dtype=U) + node[:, None] * U(0x9FB21C651E98DF25))
    row, i = np.nonzero(h < U(int(chance * 2**64)))
    return row, i, mix(h[row, i] + U(1))


def _branch(rows: DataFrame, chance: float) -> DataFrame:
    """One level down: node, vid, own, size, used (the token places on the path, which are not chosen again)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                node = b.column("node").to_numpy().view(U)
                values = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(-1, T)
                row, i, child = _children(node, values, chance)
                used = b.column("used").to_pylist()
                fresh = np.array([j not in used[r] for r, j in zip(row.tolist(), i.tolist())], bool)
                row, i, child = row[fresh], i[fresh], child[fresh]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(child.view(np.int64)), b.column("vid").take(take), b.column("own").take(take), b.column("size").take(take),
                     pa.array([used[r] + bytes([j]) for r, j in zip(row.tolist(), i.tolist())], pa.binary())],
                    ["node", "vid", "own", "size", "used"],
                )

    return rows.select("node", "vid", "own", "size", "used", "sig").mapInArrow(run, "node long, vid long, own boolean, size long, used binary")


def _roots(reps: DataFrame, trees: int, threshold: float) -> DataFrame:
    """Each representative at the root of its size class and of the next one, in every tree."""
    size_class = F.floor(F.log(F.col("size").cast("double")) / (-math.log(threshold) * 1.0001))
    at = F.array(F.struct(size_class.alias("c"), F.lit(True).alias("own")), F.struct((size_class + 1).alias("c"), F.lit(False).alias("own")))
    rows = reps.select("vid", "size", "sig", F.explode(at).alias("at")).select("*", F.explode(F.array(*map(F.lit, range(trees)))).alias("tree"))
    return rows.select(F.xxhash64("tree", "at.c").alias("node"), "vid", "at.own", "size", F.lit(b"").alias("used"), "sig")


def _alike(a: str, b: str, threshold: float) -> Column:
    """Sketches that a pair at the threshold passes with all but a chance of 1e-7: a pair that fails is lost in every tree."""
    same = threshold + (1 - threshold) / 16
    least = T * same - 6 * math.sqrt(T * same * (1 - same))

    def differing(i: int) -> str:
        x = f"({a}.k{i} ^ {b}.k{i})"
        y = f"({x} | shiftrightunsigned({x}, 2))"
        return f"bit_count(({y} | shiftrightunsigned({y}, 1)) & 1229782938247303441L)"  # the lowest bit of each 4

    return F.expr(" + ".join(map(differing, range(WORDS)))) <= T - math.ceil(least)


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return F.expr(f"100 * {a}.size >= {percent} * {b}.size AND 100 * {b}.size >= {percent} * {a}.size")


def _full_sets(docs: DataFrame, reps: DataFrame, vids: DataFrame, shingle: int) -> DataFrame:
    """(vid, set) of the representatives in ``vids``, made again from their texts."""
    need = stored(reps.join(vids, "vid", "left_semi").select("vid", F.coalesce("doc_id", F.lit(-1)).alias("id"), "sid"), "near-need")
    keyed = docs.withColumn("id", F.coalesce("doc_id", F.lit(-1)))
    rows = may_hold(keyed, "id", bit_table(need, "id")).join(need, "id").select("vid", "sid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s for _, _, data, bounds in text_blocks(b) for s in shingle_sets(*row_words(data, bounds), shingle)]
            keep = [i for i, (s, sid) in enumerate(zip(sets, b.column("sid").to_pylist())) if len(s) and _key(s) == sid]
            yield pa.RecordBatch.from_arrays([b.column("vid").take(pa.array(keep, pa.int64())), pa.array([sets[i].tobytes() for i in keep], pa.binary())], ["vid", "set"])

    # repeated rows of an id can give a set twice
    return stored(rows.mapInArrow(run, "vid long, set binary").groupBy("vid").agg(F.min("set").alias("set")), "near-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("vid")).unionByName(pairs.select(F.col("b").alias("vid"))).distinct()


def _confirmed(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b.column("x"), b.column("y"))):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                at = np.searchsorted(y, x)
                both = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield b.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    left = pairs.join(sets.select(F.col("vid").alias("a"), F.col("set").alias("x")), "a")
    both = left.join(sets.select(F.col("vid").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y")
    return stored(both.mapInArrow(run, "a long, b long"), "near-links")


def _linked(p: pa.Table, q: pa.Table, main: int, percent: int) -> pa.Table:
    """Links between the documents of two blocks around a component, one at most of each document of p with each component in q."""
    a, b = [], []
    if len(p) and len(q):
        ys = [np.frombuffer(x.as_buffer(), U) for x in q["y_set"]]
        words, place = np.unique(np.concatenate(ys), return_inverse=True)
        sizes = np.array([len(y) for y in ys])
        starts = np.cumsum(sizes) - sizes
        vid, comp = q["y_vid"].to_numpy(), q["y_comp"].to_numpy()
        for v, c, x in zip(p["vid"].to_pylist(), p["comp"].to_pylist(), p["set"]):
            x = np.frombuffer(x.as_buffer(), U)
            at = np.minimum(np.searchsorted(words, x), len(words) - 1)
            held = np.zeros(len(words), np.int64)
            held[at[words[at] == x]] = 1
            both = np.add.reduceat(held[place], starts)
            near = np.flatnonzero((100 * both >= percent * (sizes + len(x) - both)) & (comp != c) & ((comp == main) | (vid > v)))
            for i in near[np.unique(comp[near], return_index=True)[1]].tolist():
                a.append(min(v, vid[i]))
                b.append(max(v, vid[i]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _around(last: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the documents outside a node's main component with all its documents, compared in blocks of full sets.

    ``last``: main, vid, comp. Documents are dealt to blocks of bounded bytes, and
    pairs of blocks meet in a task, so that no pair is a row unless it is a link.
    """
    full = last.join(sets, "vid").select("main", "vid", "comp", "set", F.octet_length("set").alias("bytes"))
    width = F.sum(F.when(F.col("comp") != F.col("main"), F.col("bytes")))
    blocks = full.groupBy("main").agg(F.ceil(width / (1 << 19)).alias("nx"), F.ceil(F.sum("bytes") / (1 << 21)).alias("ny")).where("nx > 0")
    dealt = full.join(blocks, "main")
    x = dealt.where("comp <> main").select("main", "vid", "comp", "set", F.expr("pmod(xxhash64(vid, 3), nx)").alias("xb"), F.explode(F.expr("sequence(0L, ny - 1)")).alias("yb"))
    at = [F.col("main").alias("y_main"), F.explode(F.expr("sequence(0L, nx - 1)")).alias("y_xb"), F.expr("pmod(xxhash64(vid, 4), ny)").alias("y_yb")]
    y = dealt.select(*at, F.col("vid").alias("y_vid"), F.col("comp").alias("y_comp"), F.col("set").alias("y_set"))
    met = x.groupBy("main", "xb", "yb").cogroup(y.groupBy("y_main", "y_xb", "y_yb"))

    def compare(key: tuple, p: pa.Table, q: pa.Table) -> pa.Table:
        return _linked(p, q, key[0].as_py(), percent)

    return stored(met.applyInArrow(compare, "a long, b long").distinct(), "near-around")


def _counted(rows: DataFrame, name: str) -> DataFrame:
    """Rows of nodes with two documents at least, one of them of the node's own size class; n: the node's documents."""
    rows = stored(rows, name)
    nodes = rows.groupBy("node").agg(F.count("*").alias("n"), F.bool_or("own").alias("any_own")).where("n > 1 AND any_own")
    return rows.join(nodes.drop("any_own"), "node")


def links(
    docs: DataFrame, reps: DataFrame, percent: int = 85, shingle: int = 3, trees: int = 10, spread: float = 1.3, small: int = 16, depth: int = 5
) -> DataFrame:
    """Confirmed links (a, b) between representatives that keep every component of the similarity graph whole.

    ``spread``: branches that a pair at the threshold shares per level, on
    average; ``small``: nodes up to this size compare all pairs; ``depth``:
    levels, after which larger nodes compare the documents outside their
    main component with all.
    """
    threshold = percent / 100
    chance = spread / (threshold * T)
    rows = stored(_counted(_branch(_roots(reps, trees, threshold), chance), "near-level1"), "near-nodes1")
    profile = reps.select("vid", *[f"k{i}" for i in range(WORDS)])

    # stars: a large node's documents against one of them, drawn by a hash of node and document
    pivot = rows.where(F.col("n") > small).groupBy("node").agg(F.min_by("vid", F.xxhash64("vid", "node")).alias("pivot"))
    stars = rows.where(F.col("n") > small).join(pivot, "node").where("vid <> pivot").select(F.col("vid").alias("a"), F.col("pivot").alias("b")).distinct()
    sized = profile.join(reps.select("vid", "size"), "vid")
    x, y = sized.alias("x"), sized.alias("y")
    stars = stars.join(x, F.expr("a = x.vid")).join(y, F.expr("b = y.vid")).where(_alike("x", "y", threshold) & _sizes_fit("x", "y", percent))
    stars = stored(stars.select("a", "b"), "near-stars")
    first = _confirmed(_full_sets(docs, reps, _ends(stars), shingle), stars, percent)
    known = components(first)
    profile = stored(
        profile.join(known.select(F.col("node").alias("vid"), "root"), "vid", "left").withColumn("comp", F.coalesce("root", "vid")).drop("root"), "near-profile"
    )

    alike = _alike("x", "y", threshold) & _sizes_fit("x", "y", percent) & F.expr("x.comp <> y.comp AND (x.own OR y.own)")
    found, last = [], None
    for level in range(1, depth + 1):
        full = rows.join(profile, "vid")
        x, y = full.where(F.col("n") <= small).alias("x"), full.where(F.col("n") <= small).alias("y")
        found.append(x.join(y, F.expr("x.node = y.node AND x.vid < y.vid") & alike).select(F.col("x.vid").alias("a"), F.col("y.vid").alias("b")))
        # large nodes of more than one component go on
        parts = full.where(F.col("n") > small).groupBy("node", "comp").agg(F.count("*").alias("m"))
        mains = parts.groupBy("node").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
        large = rows.where(F.col("n") > small).join(mains, "node")
        if level == depth:
            # nodes of other trees hold the same documents around the same component: all of them once
            last = stored(large.select("main", "vid").distinct().join(profile.select("vid", "comp"), "vid"), "near-last")
            break
        down = _branch(large.select("node", "vid", "own", "size", "used").join(reps.select("vid", "sig"), "vid"), chance)
        rows = stored(_counted(down, f"near-level{level + 1}"), f"near-nodes{level + 1}")
        if rows.isEmpty():
            break
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    pairs = stored(pairs.distinct(), "near-pairs")
    if last is None:
        return first.unionByName(_confirmed(_full_sets(docs, reps, _ends(pairs), shingle), pairs, percent))
    sets = _full_sets(docs, reps, _ends(pairs).unionByName(last.select("vid")).distinct(), shingle)
    return first.unionByName(_confirmed(sets, pairs, percent)).unionByName(_around(last, sets, percent)).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, shingle: int = 3, **options) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links), kept, n_links.

    ``n_links``: confirmed links of the document's set to other sets (those
    that hold its component together; not every link inside a group).
    Documents are linked if 100 * intersection >= percent * union of their
    sets of ``shingle`` words. ``options``: of :func:`links`.
    """
    docs = texts(docs, id_col, text_col)
    base = stored(_sets(docs, shingle), "near-base")
    reps = base.where("sid IS NOT NULL").groupBy("sid").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size"), F.first("sig").alias("sig"), *[F.first(f"k{i}").alias(f"k{i}") for i in range(WORDS)]
    )
    reps = stored(reps.withColumn("vid", F.monotonically_increasing_id()), "near-reps")
    edges = links(docs, reps, percent, shingle, **options)
    roots = components(edges)
    ends = edges.select(F.col("a").alias("vid")).unionByName(edges.select(F.col("b").alias("vid"))).groupBy("vid").agg(F.count("*").alias("n_links"))
    member = (
        reps.select("sid", "vid", "doc_id")
        .join(roots.select(F.col("node").alias("vid"), "root"), "vid", "left")
        .join(ends, "vid", "left")
        .select("sid", F.coalesce("root", "vid").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "doc_id")
    )
    least = member.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    member = member.join(least, "root").select("sid", "component_id", "n_links")
    out = base.select("doc_id", "n_shingles", "sid").join(member, "sid", "left")
    component = F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group of near-duplicates, with the columns of ``docs``: the one of the smallest id.

    Rows that repeat an id are one document and stay or go together.
    """
    gone = near_duplicates(docs, id_col, text_col, **options).where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == F.col("__gone"), "left_anti")
