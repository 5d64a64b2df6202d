"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Base rules find emails, IP addresses, card and phone numbers. Those are the
seeds: the words around them are lexical patterns, and a graph joins patterns
to the identifier-like values (instances) that stand in them. Rounds of joins
and aggregations score patterns by the share of their instances that are held
to be of a kind, then unlabelled instances by the patterns they stand in. A
value that no rule takes is reported where a pattern of high confidence holds
it, if its shape allows the kind.

Null text is empty; a document without matches has empty digests; repeated
rows give one result each; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiprof.llm.common import stored, texts
from entiprof.llm.spans import Kind, cover, digest, find, place

KINDS = ("email", "ip", "card", "phone")

# Possessive loops and the look-behinds only keep the matching linear; they
# match what the plain rules match. \G: a match may begin where one ended.
RULES = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
#: Identifier-like: words with a digit or @ that single spaces join.
MENTION = Kind("mention", r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20[^\s0-9@]*+[0-9@]\S*+)*+")


def _digits(m: str) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""
    ds = F.reverse(F.split(digits, ""))
    double = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    values = F.transform(ds, lambda d, i: F.when(i % 2 == 1, double(d.cast("int"))).otherwise(d.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def _passes() -> Column:
    digits = _digits("m")
    part = lambda x: F.regexp_replace(x, "^0+", "")
    ip = F.forall(F.split("m", r"\."), lambda x: (F.length(part(x)) <= 3) & (F.concat(F.lit("0"), F.substring(part(x), 1, 3)).cast("int") <= 255))
    card = F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", ip)
        .when(F.col("kind") == "card", card)
        .when(F.col("kind") == "phone", F.length(digits).between(9, 15))
        .otherwise(False)
    )


def _kind_order(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int")


def _shapes(v: Column) -> Column:
    """The kinds that a value's shape allows."""
    digits = F.length(F.regexp_replace(v, "[^0-9]", ""))
    lettered = v.rlike(r"\p{L}")
    return F.filter(
        F.array(
            F.when(v.rlike(r"^[^@]*[\p{L}0-9][^@]*@[^@]*[\p{L}0-9]"), F.lit("email")),
            F.when(v.rlike(r"^[0-9a-f]*(?:[.:][0-9a-f]*){3,7}$"), F.lit("ip")),
            F.when(~lettered & digits.between(12, 19), F.lit("card")),
            F.when(~lettered & digits.between(7, 15), F.lit("phone")),
        ),
        lambda x: x.isNotNull(),
    )


def _edges(mentions: DataFrame, labels: DataFrame) -> DataFrame:
    """row_id, i, s, e, pattern, value, label (null: not labelled), shapes: each pattern that a mention stands in."""
    words = lambda c: F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "")
    m = mentions.join(labels, ["row_id", "kind", "i"], "left").where("mixed IS NULL OR NOT mixed")
    m = m.select(
        "row_id", "i", "s", "e", "label",
        F.regexp_replace(F.lower("m"), r"^[^\p{L}0-9+(]+|[^\p{L}0-9)]+$", "").alias("value"),
        words(F.col("before")).alias("b"), words(F.col("after")).alias("a"),
    )
    near, far, right = F.get("b", F.size("b") - 1), F.get("b", F.size("b") - 2), F.get("a", F.lit(0))
    patterns = F.array(
        F.concat(F.lit("1 "), near), F.concat(F.lit("2 "), far, F.lit(" "), near), F.concat(F.lit("3 "), near, F.lit(" _ "), right)
    )
    return m.select(
        "row_id", "i", "s", "e", "label", "value", _shapes(F.col("value")).alias("shapes"),
        F.explode(F.filter(patterns, lambda p: p.isNotNull())).alias("pattern"),
    )


def _score_patterns(graph: DataFrame, scores: DataFrame) -> DataFrame:
    """pattern, kind, confidence, seeds: the mean score of its distinct values, and how many are seeds."""
    values = graph.groupBy("pattern").agg(F.count("*").alias("n"))
    hits = graph.join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("total"), F.sum("seed").alias("seeds"))
    return hits.join(values, "pattern").select("pattern", "kind", (F.col("total") / F.col("n")).alias("confidence"), "seeds")


def contextual(hits: DataFrame, base: DataFrame, rounds: int, min_confidence: float, min_seeds: int) -> DataFrame:
    """Added spans (row_id, kind, s, e) for mentions that no base span touches."""
    mentions = place(hits.where(F.col("kind") == MENTION.name))
    placed = base.select("row_id", "kind", "s", "e")

    met = F.expr("m.row_id = b.row_id AND m.stretch = b.stretch AND m.s < b.e AND b.s < m.e")
    labels = (
        cover(mentions.select("row_id", "kind", "i", "s", "e")).alias("m")
        .join(cover(placed).alias("b"), met)
        .groupBy("m.row_id", "m.kind", "m.i")
        .agg(F.min("b.kind").alias("label"), (F.min("b.kind") != F.max("b.kind")).alias("mixed"))
    )
    edges = stored(_edges(mentions, labels), "pii-edges")
    graph = edges.select("pattern", "value").distinct()
    seeds = edges.where("label IS NOT NULL").select("value", F.col("label").alias("kind")).distinct()
    seeds = seeds.select("value", "kind", F.lit(1.0).alias("score"), F.lit(1).alias("seed"))
    open_values = edges.where("label IS NULL").select("value", "pattern", F.explode("shapes").alias("kind")).distinct()
    scores = seeds
    for _ in range(rounds):
        patterns = stored(_score_patterns(graph, scores), "pii-patterns")
        good = patterns.where((F.col("confidence") >= min_confidence) & (F.col("seeds") >= min_seeds))
        # one minus the chance that every pattern that holds the value errs
        found = open_values.join(good, ["pattern", "kind"]).groupBy("value", "kind")
        found = found.agg((1 - F.exp(F.sum(F.log(1.0001 - F.col("confidence"))))).alias("score"), F.lit(0).alias("seed"))
        scores = seeds.unionByName(found.join(seeds.select("value", "kind"), ["value", "kind"], "left_anti"))
    taken = edges.where("label IS NULL").select("row_id", "i", "s", "e", "pattern", F.explode("shapes").alias("kind"))
    best = taken.join(good, ["pattern", "kind"]).groupBy("row_id", "i", "s", "e")
    return best.agg(F.max_by("kind", F.struct("confidence", "seeds", "kind")).alias("kind")).select("row_id", "kind", "s", "e")


def find_private(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, min_confidence: float = 0.7, min_seeds: int = 5
) -> DataFrame:
    """Per document its base and added spans.

    Returns doc_id, base and spans: arrays of structs (k, kind, s, e), k the
    kind's place in KINDS, s and e code points, e exclusive, sorted by k then s.
    ``rounds``: of scoring; a pattern discovers from ``min_confidence`` and
    ``min_seeds`` distinct seed values on.
    """
    hits = stored(find(texts(docs, id_col, text_col), [*RULES, MENTION]), "pii-hits")
    ruled = place(hits.where(F.col("kind") != MENTION.name))
    base = ruled.where(_passes())
    added = contextual(hits, base, rounds, min_confidence, min_seeds)
    every = base.select("row_id", "kind", "s", "e", F.lit(True).alias("ruled")).unionByName(
        added.select("row_id", "kind", "s", "e", F.lit(False).alias("ruled"))
    )
    one = F.struct(_kind_order(F.col("kind")).alias("k"), "s", "e", "kind", "ruled")
    spans = every.groupBy("row_id").agg(F.array_sort(F.collect_list(one)).alias("spans"))
    rows = hits.select("row_id", "doc_id").distinct()
    none = F.array().cast(spans.schema["spans"].dataType)
    out = rows.join(spans, "row_id", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
    return out.select("doc_id", F.filter("spans", lambda x: x["ruled"]).alias("base"), "spans")


def report(docs: DataFrame, **options) -> DataFrame:
    """The contract's columns: counts of base spans by kind, their digest, and all spans as text."""
    found = find_private(docs, **options)
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(n, KINDS), F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans")
    )
