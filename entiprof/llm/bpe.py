"""BPE encoding and decoding of a public vocabulary with segment trees over pair ranks.

The leaves of a word's tree are the ranks of its adjacent symbol pairs, each
inner node the smaller of its children, so the root is the leftmost pair of the
lowest rank. A merge updates at most three leaves, each in logarithmic time, until
no mergeable pair is left. The new words of a slice of texts are merged
together: one matrix of trees for all words of one length, a row a word. Words
repeat, so every task keeps a bounded memory of encoded words, of which the part that was
not met lately goes first. Texts are encoded whole.

The vocabulary file (a tokenizer of normalizers NFC, white space to one space
and lower case; words, single digits and runs of other characters; byte-level
symbols with a word-end mark) is read by the driver and broadcast as arrays: its size is
fixed. Its special tokens are found in the text as they stand.

Null text is empty: no ids. Repeated rows give one result each; an empty table gives
an empty one; other columns, of whatever name, are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from entiprof.llm.common import give_back, row_slices, texts

#: Words in each of the two halves of a task's memory; longer words are not remembered.
REMEMBERED, LONGEST = 60_000, 64
#: Bytes of text in a slice, about, and words merged at once.
SLICE_BYTES, TOGETHER = 1 << 20, 4096
_NONE = 1 << 62
_PLACE = 0xFFFFFFFF


class Vocabulary:
    """Symbols, merges and special tokens, and the patterns that cut a text into words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        ids, end = whole["model"]["vocab"], whole["model"]["end_of_word_suffix"] or ""
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.tokens = [""] * (max([*ids.values(), *self.specials.values()]) + 1)
        for t, i in [*ids.items(), *self.specials.items()]:
            self.tokens[i] = t
        pairs = [m if isinstance(m, list) else m.split(" ") for m in whole["model"]["merges"]]
        key = np.array([ids[a] * len(self.tokens) + ids[b] for a, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)  # by rank
        # of a pair that stands twice the later rank counts, as in a table that is filled in order
        last = len(key) - 1 - np.unique(key[::-1], return_index=True)[1]
        self.pairs, self.ranks = key[last], last.astype(np.int64)
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int64)
        self.last = np.array([ids[s + end] for s in symbols], np.int64)
        self.patterns = _patterns()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "rank_of"}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 of one that does not merge."""
        key = a * len(self.tokens) + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], -1)

    @cached_property
    def rank_of(self) -> dict[int, int]:
        return dict(zip(self.pairs.tolist(), self.ranks.tolist()))


# Letters and numbers, and pairs of upper and lower case (first, last, what is added), that the library's
# tables have and Python's have not.
LATER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
LATER_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
LATER_CASE = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1),
    (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)
#: Fixed: the code points of the White_Space property.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _class(kind: str, later: Iterable[tuple[int, int]]) -> str:
    """A regular-expression class of the code points whose category begins with ``kind``, and those of ``later``."""
    held = np.fromiter((unicodedata.category(chr(c))[0] == kind for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    for a, b in later:
        held[a : b + 1] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[False], held, [False]]).astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edge.reshape(-1, 2).tolist())


@lru_cache(1)
def _patterns() -> tuple[str, str, str]:
    """Words, words of lower-case ASCII text, and letters whose lower case Python does not know.

    No word holds white space, so how much of it stands between words plays no part."""

    def words(letter: str, number: str) -> str:
        # Fixed: the split pattern of the vocabulary file. Its parts begin with different characters but for the
        # endings and the runs of other characters, so letters may come first.
        return f"[{letter}]+|[{number}]|'s|'t|'re|'ve|'m|'ll|'d|[^{_SPACE}{letter}{number}]+"

    later = "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b, _ in LATER_CASE) + "]"
    return words(_class("L", LATER_LETTERS), _class("N", LATER_NUMBERS)), words("a-z", "0-9"), later


@lru_cache(1)
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable Latin-1, else one from 256 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


def merge(symbols: list[int], v: Vocabulary) -> list[int]:
    """Merge the leftmost pair of the lowest rank until none is left; for a word by itself."""
    n, rank_of, size = len(symbols), v.rank_of, len(v.tokens)
    if n < 2:
        return symbols
    leaves = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [_NONE] * (2 * leaves)  # a leaf: rank << 32 | place
    for i in range(n - 1):
        if (k := rank_of.get(symbols[i] * size + symbols[i + 1])) is not None:
            tree[leaves + i] = k << 32 | i
    for i in range(leaves - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def put(i: int, value: int) -> None:
        i += leaves
        tree[i] = value
        while i > 1:
            i >>= 1
            least = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == least:
                break
            tree[i] = least

    def leaf(i: int) -> int:
        k = rank_of.get(symbols[i] * size + symbols[after[i]]) if after[i] < n else None
        return _NONE if k is None else k << 32 | i

    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while tree[1] != _NONE:
        i, k = tree[1] & _PLACE, tree[1] >> 32
        j = after[i]
        symbols[i] = int(v.merged[k])
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        if j < n - 1:
            put(j, _NONE)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    out, i = [], 0
    while i < n:
        out.append(symbols[i])
        i = after[i]
    return out


def merge_together(symbols: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """:func:`merge` of every row of a matrix: what is left of all rows one after the other, and how many of each."""
    rows, n = symbols.shape
    if n < 2:
        return symbols.ravel(), np.full(rows, n)
    leaves = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = np.full((rows, 2 * leaves), _NONE, np.int64)

    def leaf(a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
        k = v.rank(a, b)
        return np.where(k < 0, _NONE, k << 32 | place)

    tree[:, leaves : leaves + n - 1] = leaf(symbols[:, :-1], symbols[:, 1:], np.arange(n - 1))
    level = leaves
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    after = np.broadcast_to(np.arange(1, n + 1), (rows, n)).copy()
    before = np.broadcast_to(np.arange(-1, n - 1), (rows, n)).copy()
    left = np.ones((rows, n), bool)
    r = np.arange(rows)
    while True:
        root = tree[r, 1]
        r, root = r[root != _NONE], root[root != _NONE]
        if len(r) == 0:
            break
        i, k = root & _PLACE, root >> 32
        j = after[r, i]
        beyond, ahead = after[r, j], before[r, i]
        symbols[r, i] = v.merged[k]
        left[r, j] = False
        after[r, i] = beyond
        more, some = beyond < n, ahead >= 0
        before[r[more], beyond[more]] = i[more]
        gone = np.where(j < n - 1, j, i)  # the last symbol has no leaf
        tree[r, leaves + gone] = _NONE
        tree[r, leaves + i] = np.where(more, leaf(symbols[r, i], symbols[r, np.minimum(beyond, n - 1)], i), _NONE)
        tree[r[some], leaves + ahead[some]] = leaf(symbols[r[some], ahead[some]], symbols[r[some], i[some]], ahead[some])
        nodes = [leaves + gone, leaves + i, leaves + np.where(some, ahead, i)]
        for _ in range(leaves.bit_length() - 1):
            for x in nodes:
                x >>= 1
                tree[r, x] = np.minimum(tree[r, 2 * x], tree[r, 2 * x + 1])
    return symbols[left], left.sum(1)


class Codec:
    """Encodes and decodes texts; ids and tokens of words are remembered."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.words, self.ascii_words, self.later = map(re.compile, vocabulary.patterns)
        self.lower = {c: c + d for a, b, d in LATER_CASE for c in range(a, b + 1)}
        self.special = re.compile("|".join(map(re.escape, sorted(vocabulary.specials, key=len, reverse=True)))) if vocabulary.specials else None
        self.young: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}

    def split(self, text: str) -> list:
        """The words of a text; a special token is a tuple of itself."""
        if self.special is None or not any(s in text for s in self.v.specials):
            return self._plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self._plain(text[at : m.start()])
            out.append((m[0],))
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        # lower case of each character by itself: a final capital sigma is no exception
        text = text.replace("Σ", "σ")
        if self.later.search(text):
            text = text.translate(self.lower)
        return self.words.findall(text.lower())

    def _found(self, ids: np.ndarray) -> tuple[bytes, str]:
        return ids.astype("<u4").tobytes(), self.decode(ids)

    def _new(self, words: list[str]) -> Iterator[tuple[str, tuple[bytes, str]]]:
        """Encodes words: those of one length together, long ones by themselves."""
        by_length: dict[int, list[tuple[str, bytes]]] = defaultdict(list)
        for w in words:
            raw = w.encode()
            by_length[len(raw)].append((w, raw))
        for n, group in by_length.items():
            if n > LONGEST:
                for w, raw in group:
                    ids = self.v.inner[np.frombuffer(raw, np.uint8)]
                    ids[-1] = self.v.last[raw[-1]]
                    yield w, self._found(np.array(merge(ids.tolist(), self.v)))
                continue
            for at in range(0, len(group), TOGETHER):
                some = group[at : at + TOGETHER]
                data = np.frombuffer(b"".join([raw for _, raw in some]), np.uint8).reshape(-1, n)
                symbols = self.v.inner[data]
                symbols[:, -1] = self.v.last[data[:, -1]]
                ids, count = merge_together(symbols, self.v)
                raw, ids = ids.astype("<u4").tobytes(), ids.tolist()
                end = 0
                for (w, _), c in zip(some, count.tolist()):
                    end += c
                    yield w, (raw[4 * (end - c) : 4 * end], " ".join([self.v.tokens[i] for i in ids[end - c : end]]))

    def encode(self, texts: list[str]) -> list[list[tuple[bytes, str]]]:
        """Per text, of each word its ids as little-endian 32-bit integers, and its tokens with spaces between."""
        split = [self.split(t) for t in texts]
        now: dict = {}
        missing = []
        for w in set().union(*split):
            if isinstance(w, tuple):
                now[w] = np.array([self.v.specials[w[0]]], "<u4").tobytes(), w[0]
            elif (found := self.young.get(w) or self.old.get(w)) is not None:
                now[w] = found
            else:
                missing.append(w)
        now.update(self._new(missing))
        self.young.update((w, f) for w, f in now.items() if isinstance(w, str) and len(w) <= LONGEST)
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        return [[now[w] for w in words] for words in split]

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens of ids, special ones too, joined by spaces (the vocabulary names no decoder)."""
        return " ".join([self.v.tokens[i] for i in ids])


def load(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (32-bit little-endian), decoded: every whole text encoded with the vocabulary at ``path`` and decoded again."""
    return _coded(docs, path, id_col, text_col, digest=False)


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of :func:`encode`'s columns."""
    return _coded(docs, path, id_col, text_col, digest=True)


def _coded(docs: DataFrame, path: str, id_col: str, text_col: str, digest: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for whole in batches:
            for b in row_slices(whole, "text", SLICE_BYTES):
                n, ids, decoded = [], [], []
                for parts in codec.encode(b.column("text").to_pylist()):
                    raw = b"".join([p[0] for p in parts])
                    out = " ".join([p[1] for p in parts])
                    n.append(len(raw) // 4)
                    ids.append(hashlib.sha256(raw).hexdigest() if digest else raw)
                    decoded.append(hashlib.sha256(out.encode()).hexdigest() if digest else out)
                columns = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string() if digest else pa.binary()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)
        del codec
        give_back()

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "n_tokens", "ids", "decoded"]
    schema = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digest else "ids binary, decoded string")
    return texts(docs, id_col, text_col).mapInArrow(run, schema)
