"""Plain versions of the contracts, one document or pair at a time."""

from __future__ import annotations

import bisect
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def crc_mod5(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode()) % 5 if doc_id is not None else 0


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def private(text: str) -> list[tuple[str, int, int]]:
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m[0])]


def secret(text: str) -> list[tuple[str, int, int]]:
    rules = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]
    found = [(m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(rules) for m in p.finditer(text) if ok(m)]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def edited(docs: list[tuple[int, str]]) -> dict[int, str]:
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (k, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        third = len(t) // 3
        out[k] = t[: len(t) - third] + nxt[:third]
    return out


def shingles(text: str, k: int) -> set:
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def groups(docs: list[tuple[int, str]], percent: int = 85, k: int = 3) -> dict[int, tuple[int, int]]:
    """doc_id: (set size, smallest doc_id reachable)."""
    sets = {d: frozenset(shingles(t or "", k)) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_size = sorted((len(s), d) for d, s in sets.items() if s)
    for n, a in by_size:
        for m, b in by_size[bisect.bisect_left(by_size, (n, a)) + 1 :]:
            if 100 * n < percent * m:
                break
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (n + m - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def base_scores(docs: list[tuple[int, str]]) -> dict[int, tuple[int, int, int, float]]:
    from collections import Counter

    tokens = {d: [*WORD.findall(lower(t or "")), None] for d, t in docs}
    c = Counter(w for d, ws in tokens.items() if crc_mod5(d) != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    return {d: (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for d, ws in tokens.items()}


def first_runs(docs: list[tuple[int, str]], min_run: int) -> dict[int, set[int]]:
    """Word places that lie in a run of min_run words that occurs earlier (by doc_id, then place)."""
    first, out = {}, {}
    for d, t in sorted(docs):
        w = WORD.findall(t or "")
        out[d] = set()
        for i in range(len(w) - min_run + 1):
            g = tuple(w[i : i + min_run])
            if g in first:
                out[d] |= set(range(i, i + min_run))
            else:
                first[g] = (d, i)
    return out


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0) -> dict:
    """By bisection: the level at which min(weight * level, most * size) sum to the share of all words."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    at = lambda level: {s: min(weights[i % len(weights)] * level, most * sizes[s]) for i, s in enumerate(order)}
    low, high = 0.0, 2.0 * most * sum(sizes.values()) + 1
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(at(mid).values()) < share * sum(sizes.values()) else (low, mid)
    return at(high)
