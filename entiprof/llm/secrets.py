"""Secret scans with multipart credential linking, in DataFrame operations only.

Base rules find labelled values, cloud access ids and long hex strings.
Weaker candidates (logins and upper-case ids, unlabelled mixed strings,
endpoints) are reported only where the complementary parts of a credential
stand in one scope: the same document, at most ``scope`` code points apart. The
interval join is an equality join on scope-wide stretches of the document and
their neighbours.

Null text is empty; repeated rows give one result each; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiprof.llm.common import stored, texts
from entiprof.llm.spans import Kind, digest, find, overlapping, place

BASE = ("assign", "access", "hex")
WEAK = ("login", "mixed", "endpoint")

RULES = [
    Kind("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)""", 2),
    Kind("access", r"AKIA[A-Z0-9]++"),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+"),
]
WEAK_RULES = [
    Kind("login", r"""(?i:\b(?:user(?:name)?|login|account|client_?id|access_?id))["']?+\x20*+[:=]\x20*+["']?+[A-Za-z0-9_.@-]{3,}+|(?<![A-Za-z0-9+/_=-])(?=[A-Z0-9]*+(?![A-Za-z0-9+/_=-]))(?=[A-Z]*+[0-9])(?=[0-9]*+[A-Z])[A-Z0-9]{16,}+"""),
    Kind("mixed", r"(?<![A-Za-z0-9+/_=-])(?=[a-z+/_=-]*+[A-Z0-9])(?=[A-Za-z+/_=-]*+[0-9])(?=[A-Z0-9+/_=-]*+[a-z])(?=[a-z0-9+/_=-]*+[A-Z])[A-Za-z0-9+/_=-]{16,}+"),
    Kind("endpoint", r"""(?i:\b(?:https?|ftps?|ssh|s3|jdbc:[a-z]{2,12}|postgres(?:ql)?|mysql|redis|amqps?|mongodb)://[^\s"'<>]++)|(?<![A-Za-z0-9.-])(?:[a-z0-9-]++\.)++[a-z0-9-]++:[0-9]{2,5}+(?![0-9])"""),
]


def _passes() -> Column:
    return (
        F.when(F.col("kind") == "assign", F.length("p") >= 6)
        .when(F.col("kind") == "access", F.length("m") >= 20)
        .otherwise(True)
    )


def _near(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """Spans of ``left`` with one of ``right`` at most ``scope`` code points away."""
    # a span that reaches into later stretches stands in each of them, on both sides
    stretches = lambda before, after: F.explode(F.sequence(F.floor(F.col("s") / scope) - before, F.floor(F.col("e") / scope) + after)).alias("stretch")
    l = left.select("*", stretches(0, 0)).alias("l")
    r = right.select("row_id", "s", "e", stretches(1, 1)).alias("r")
    met = F.expr(f"l.row_id = r.row_id AND l.stretch = r.stretch AND l.s - r.e <= {scope} AND r.s - l.e <= {scope}")
    return l.join(r, met, "left_semi").drop("stretch").distinct()


def linked(weak: DataFrame, base: DataFrame, scope: int) -> DataFrame:
    """The weak candidates that complementary parts confirm.

    A login needs a secret (base assign or hex, or a mixed string) nearby, a
    mixed string an id (base access, or a login), an endpoint both.
    """
    part = lambda df, *kinds: df.where(F.col("kind").isin(*kinds)).select("row_id", "kind", "i", "s", "e")
    secrets = part(base, "assign", "hex").unionByName(part(weak, "mixed"))
    ids = part(base, "access").unionByName(part(weak, "login"))
    return (
        _near(part(weak, "login"), secrets, scope)
        .unionByName(_near(part(weak, "mixed"), ids, scope))
        .unionByName(_near(_near(part(weak, "endpoint"), ids, scope), secrets, scope))
    )


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 400) -> DataFrame:
    """doc_id, base and spans: arrays of structs (s, k, kind, e), sorted by start, then kind as listed in BASE and WEAK."""
    hits = stored(find(texts(docs, id_col, text_col), [*RULES, *WEAK_RULES]), "secret-hits")
    placed = place(hits)
    base = placed.where(F.col("kind").isin(*BASE) & _passes())
    weak = overlapping(placed.where(F.col("kind").isin(*WEAK)), base, "left_anti")
    every = base.select("row_id", "kind", "s", "e").unionByName(linked(weak, base, scope).select("row_id", "kind", "s", "e"))
    order = F.array_position(F.array(*map(F.lit, BASE + WEAK)), F.col("kind")).cast("int")
    spans = every.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("s", order.alias("k"), "e", "kind"))).alias("spans"))
    rows = hits.select("row_id", "doc_id").distinct()
    none = F.array().cast(spans.schema["spans"].dataType)
    out = rows.join(spans, "row_id", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
    return out.select("doc_id", F.filter("spans", lambda x: x["kind"].isin(*BASE)).alias("base"), "spans")


def report(docs: DataFrame, **options) -> DataFrame:
    """The contract's columns."""
    found = find_secrets(docs, **options)
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(n, BASE), F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans")
    )
