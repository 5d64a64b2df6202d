"""Main text of web pages by template deduction over equivalence classes.

A page is read as tokens: the opening and closing tags of its blocks, each told
apart by its path of enclosing blocks, and, outside of the article, its runs of
text. A token's occurrence vector says how often it stands in every page of its
host. Tokens of one host with equal vectors form a class; classes that stand in
three tenths of the host's pages and hold two tokens or more are kept, and are
valid if their tokens come in the same order in every page and every time inside
the same gap of the same enclosing class. Valid classes, nested, are the host's template;
what stands between their tokens are its slots. A slot is main text if it lies in
an article, or, on hosts without any, in the path with the most text outside of links
or in a block of it. Text of an article is data and stays, however often it repeats;
elsewhere a run of text that is itself a token of the template goes.

Hosts of fewer than three pages have no template: their pages, and pages without
anything in the host's main slots, are judged by themselves, by the same rule. Menus, headers
outside of articles, footers, sidebars, forms, scripts, adverts, notices and comments
go wherever their element, class, id or role says so.

Vectors are compared by an order-free hash that is combined where the pages are
read, so a host that holds a third of all pages is no large group. A host's template is one
row, at most ten thirds of the tokens of its average page; pages meet it in a join
that Spark broadcasts only if the stored templates are small, and splits where
one host's pages are many.

Null and blank pages give an empty text; a null url is a host of its own. Repeated
rows give one result each and count in the vectors; an empty table gives an empty
one; other columns, of whatever name, are not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiprof.llm.common import give_back, row_slices, ship, stored

#: A class stands in this share of the host's pages at least, in percent, and in this many pages and tokens.
SUPPORT, PAGES, TOKENS = 30, 3, 2

# Elements of HTML by their part in a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math select object canvas audio video".split())
TO_THE_END = frozenset("script style title textarea xmp".split())
DROPPED = frozenset("nav footer aside form button menu dialog head fieldset label input".split())
BREAKS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table menu".split())
# Words of classes, ids and roles that name what is not the article.
NAMES = frozenset(
    "ad ads adv advert advertisement adverts advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification alert"
    " newsletter subscribe subscription signup social share sharing related recommended recommendations sidebar sidenav menu nav navbar navigation breadcrumb"
    " breadcrumbs footer masthead topbar toolbar comment comments disqus reply replies respond popup modal overlay pagination pager login search skip widget widgets"
    " contentinfo complementary".split()
)

_TAG = re.compile(
    r"""<(?:!--(?:>|->|(?s:.*?)(?:--!?>|\Z))|(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([A-Za-z][^\s/>]*)([^>]*)>|[!?/][^>]*(?:>|\Z)|/?[A-Za-z][^>]*\Z)"""
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_WORD = re.compile(r"[a-z]+")

OUTSIDE, ARTICLE, AWAY = 0, 1, 2


def key64(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(1 << 16)
def _step(path: int, what: str) -> int:
    return key64(f"{path}/{what}")


@lru_cache(len(RAW))
def _raw_end(name: str) -> re.Pattern:
    return re.compile(f"</{name}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I)


@lru_cache(1 << 14)
def _element(name: str, attributes: str) -> tuple[str, bool]:
    """What tells the element apart (its name and classes), and whether its names put it away."""
    named, away = [name], name in DROPPED
    for attribute, *values in _ATTRIBUTE.findall(attributes):
        value, attribute = "".join(values).lower(), attribute.lower()
        if attribute == "class":
            named += sorted(set(value.split()))
        if attribute == "hidden" or not NAMES.isdisjoint(_WORD.findall(value)) and name not in ("html", "body"):
            away = True
    return " ".join(named), away


class Tag(NamedTuple):
    """A block's opening or closing tag: the block's path and that of the block around it."""

    key: int
    path: int
    outer: int


class Run(NamedTuple):
    """A block's text, its white space single spaces."""

    key: int
    path: int
    region: int
    link_chars: int
    text: str


def read_page(page: str) -> list[Tag | Run]:
    """The page's block tags and runs of text in order; text put away is left out."""
    out: list[Tag | Run] = []
    stack: list[tuple[str, int, int]] = []  # element, path, region
    pieces: list[str] = []
    path, region, links, linked, in_run, at = 0, OUTSIDE, 0, 0, (0, OUTSIDE), 0
    is_open: Counter[str] = Counter()
    endless: set[str] = set()  # elements that do not end on the rest of the page

    def text(raw: str) -> None:
        nonlocal linked, in_run
        if region != AWAY and raw:
            if not pieces:
                in_run = path, region
            pieces.append(entities.unescape(raw))
            if links:
                linked += len(raw)

    def flush() -> None:
        nonlocal linked
        if pieces:
            words = " ".join("".join(pieces).split())
            if words:
                out.append(Run(_step(in_run[0], f"#{key64(words)}"), *in_run, linked, words))
            pieces.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal path, region, links
        while len(stack) > to:
            name, outer, outer_region = stack.pop()
            is_open[name] -= 1
            if name == "a":
                links -= 1
            elif name not in INLINE:
                flush()
                if name != "p":
                    out.append(Tag(_step(path, "/"), path, outer))
            path, region = outer, outer_region

    while (m := _TAG.search(page, at)) is not None:
        text(page[at : m.start()])
        at = m.end()
        close, name, attributes = m[1] or m[4], m[2] or m[5], m[3] or m[6] or ""
        if name is None:
            continue
        name = name.lower()
        if close:
            if name == "br":
                text(" ")
                continue
            if name not in INLINE:
                flush()
            for i in range(len(stack) - 1, -1, -1) if is_open[name] else ():
                if stack[i][0] == name:
                    pop(i)
                    break
                if name in INLINE and stack[i][0] not in INLINE:
                    break  # an inline element does not end beyond its block
            continue
        if name == "br":
            text(" ")
            continue
        if name in RAW:
            end = None if name in endless else _raw_end(name).search(page, at)
            if end is not None:
                at = end.end()
            elif name in TO_THE_END:
                at = len(page)
            endless |= {name} if end is None else set()
            continue
        if name not in INLINE:
            flush()
            if name in BREAKS_P or name == "body":
                if is_open["head"]:
                    pop(next(i for i, x in enumerate(stack) if x[0] == "head"))
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        pop(i)
                        break
                    if stack[i][0] not in INLINE:
                        break
            if name in CLOSES:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in CLOSES[name]:
                        pop(i)
                        if name != "tr":
                            break
                    elif stack[i][0] in HOLDS:
                        break
        what, away = _element(name, attributes)
        if name in VOID:
            continue
        stack.append((name, path, region))
        is_open[name] += 1
        if region != AWAY:
            if away or (name == "header" and region == OUTSIDE):
                region = AWAY
            elif name in ("article", "main"):
                region = ARTICLE
        if name == "a":
            links += 1
        elif name not in INLINE and name != "p":
            outer, path = path, _step(path, what)
            out.append(Tag(_step(path, "+"), path, outer))
    text(page[at:])
    flush()
    pop(0)
    return out


def _tokens(page: list[Tag | Run]) -> Iterator[int]:
    """Keys of the page's tokens in order; runs of an article are data."""
    for x in page:
        if isinstance(x, Tag) or x.region == OUTSIDE:
            yield x.key


def _within(page: list[Tag | Run], path: int) -> set[int]:
    """The paths of the blocks in ``path``, itself included."""
    out = {path}
    out.update(x.path for x in page if isinstance(x, Tag) and x.outer in out)
    return out


def main_text(page: list[Tag | Run], template: set[int], main: int | None) -> str:
    """The runs of the page's main slots, a line each.

    ``template`` are the tokens of the host's template; ``main`` is the path of its main slots,
    None if they are articles or unknown.
    """
    data = [x for x in page if isinstance(x, Run) and x.key not in template]
    kept = [x.text for x in data if x.region == ARTICLE]
    if not kept and main is not None:
        within = _within(page, main)
        kept = [x.text for x in data if x.path in within]
    if not kept:
        score: dict[int, int] = defaultdict(int)
        for x in data:
            score[x.path] += len(x.text) - 2 * x.link_chars
        within = _within(page, max(score, key=score.get, default=0))
        kept = [x.text for x in data if x.path in within]
    return "\n".join(kept)


_HOST = r"^[a-z][a-z0-9+.-]*://([^/?#]*)"


def _pages(pages: DataFrame) -> DataFrame:
    ship(pages.sparkSession)
    host = F.coalesce(F.regexp_extract(F.lower("url"), _HOST, 1), F.lit(""))
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))


def _mapped(pages: DataFrame, make, schema: str) -> DataFrame:
    """Rows that ``make`` yields, as lists of columns, for slices of the pages."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in row_slices(whole, "html"):
                rows = list(make(b))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        give_back()

    types = [{"long": pa.int64(), "string": pa.string(), "int": pa.int32()}[c.split()[1]] for c in schema.split(", ")]
    return pages.mapInArrow(run, schema)


def token_classes(pages: DataFrame) -> DataFrame:
    """host, token, class: tokens of frequent classes of equal occurrence vectors.

    A vector's hash is the exclusive or of one hash per page and count.
    """

    def count(b: pa.RecordBatch) -> Iterator[tuple]:
        for row, host, page in zip(b.column("row").to_pylist(), b.column("host").to_pylist(), b.column("html").to_pylist()):
            for token, n in Counter(_tokens(read_page(page))).items():
                yield row, host, token, n

    numbered = pages.select(F.monotonically_increasing_id().alias("row"), "host", "html")
    seen = _mapped(numbered, count, "row long, host string, token long, n int")
    vectors = seen.groupBy("host", "token").agg(F.count("*").alias("pages"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("row", "n")).alias("vector"))
    size = pages.groupBy("host").agg(F.count("*").alias("of"))
    frequent = vectors.where(F.col("pages") >= PAGES).join(size, "host").where(F.col("pages") * 100 >= F.col("of") * SUPPORT)
    frequent = frequent.select("host", "token", F.xxhash64("pages", "total", "vector").alias("class"))
    large = frequent.groupBy("host", "class").agg(F.count("*").alias("tokens")).where(F.col("tokens") >= TOKENS)
    return frequent.join(large.drop("tokens"), ["host", "class"])


def _by_host(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per host with its rows as an array ``known``."""
    return rows.groupBy("host").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("known"))


def place(page: list[Tag | Run], classes: dict[int, int]) -> Iterator[tuple[int, int, int]]:
    """(class, order of its tokens, enclosing gap) of every class on the page.

    The order is a hash of the class's tokens in their first round, or 0 if a later
    round differs; the gap is a hash of the enclosing class and how many of its tokens
    have passed, or 0 if rounds stand in different gaps.
    """
    rounds: dict[int, list[list[int]]] = defaultdict(list)
    gaps: dict[int, set[int]] = defaultdict(set)
    size = Counter(classes.values())
    opened: list[int] = []  # classes with an unfinished round, outermost first
    for token in _tokens(page):
        c = classes.get(token)
        if c is None:
            continue
        if c in opened:
            while opened[-1] != c:
                opened.pop()
        else:
            rounds[c].append([])
            gaps[c].add(key64(f"{opened[-1]}:{len(rounds[opened[-1]][-1])}") if opened else 1)
            opened.append(c)
        rounds[c][-1].append(token)
        if len(rounds[c][-1]) == size[c]:
            opened.pop()
    for c, found in rounds.items():
        same = all(r == found[0] for r in found)
        yield c, key64(str(found[0])) if same else 0, gaps[c].pop() if len(gaps[c]) == 1 else 0


def deduce(pages: DataFrame) -> DataFrame:
    """host, token, path: the templates. A row holds a token of a valid class, or, of a host without
    articles, the path of its main slots."""
    classes = stored(token_classes(pages), "template-classes")
    known = stored(_by_host(classes, "token", "class"), "template-candidates")

    def look(b: pa.RecordBatch) -> Iterator[tuple]:
        for host, page, pairs in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), b.column("known").to_pylist()):
            candidates = {p["token"]: p["class"] for p in pairs}
            items = read_page(page)
            for c, order, gap in place(items, candidates):
                yield host, c, order, gap, None, None, 0
            for x in items:
                if isinstance(x, Run) and x.key not in candidates:
                    yield host, None, None, None, x.path, x.region, len(x.text) - 2 * x.link_chars

    schema = "host string, class long, order long, gap long, path long, region int, score long"
    seen = _mapped(pages.join(known, "host"), look, schema)
    facts = stored(seen.groupBy("host", "class", "order", "gap", "path", "region").agg(F.sum("score").alias("score")), "template-facts")

    forms = facts.where("class IS NOT NULL").groupBy("host", "class").agg(F.count("*").alias("forms"), F.min("order").alias("order"), F.min("gap").alias("gap"))
    valid = forms.where("forms = 1 AND order <> 0 AND gap <> 0").select("host", "class")
    tokens = classes.join(valid, ["host", "class"]).select("host", "token", F.lit(None).cast("long").alias("path"))

    slots = facts.where("path IS NOT NULL").groupBy("host", "path").agg(F.sum("score").alias("score"), F.max("region").alias("region"))
    best = slots.groupBy("host").agg(F.max("region").alias("region"), F.max_by("path", F.struct("score", "path")).alias("path"))
    main = best.where(F.col("region") != ARTICLE).select("host", F.lit(None).cast("long").alias("token"), "path")
    return tokens.unionByName(main)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every whole page."""
    pages = _pages(pages)
    known = stored(_by_host(deduce(pages), "token", "path"), "template")
    rows = pages.join(known, "host", "left")

    def run(b: pa.RecordBatch) -> Iterator[tuple]:
        for page_id, url, page, pairs in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "known"))):
            template = {p["token"] for p in pairs or () if p["token"] is not None}
            main = [p["path"] for p in pairs or () if p["path"] is not None]
            text = main_text(read_page(page), template, main[0] if main else None)
            yield page_id, url, text, len(text)

    kind = dict(pages.dtypes)["page_id"]
    out = _mapped(rows.withColumn("page_id", F.col("page_id").cast("long")), run, "page_id long, url string, text string, n_chars long")
    return out if kind == "bigint" else out.withColumn("page_id", F.col("page_id").cast(kind))
