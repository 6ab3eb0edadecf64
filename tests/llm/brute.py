"""Plain forms of what the operators compute, one document or pair at a time."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return SPACE.findall(text or "")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None) -> frozenset:
    w = words(lower(text or ""))
    if not w:
        return frozenset()
    if len(w) < 5:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4))


def near_duplicates(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(a: int) -> int:
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            n = len(sets[a] & sets[b])
            if sets[a] and 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


PERSONAL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def personal(text: str | None) -> list[tuple[str, int, int]]:
    out = []
    for rank, (kind, pattern) in enumerate(PERSONAL.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
    r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)""")


def secret(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
            if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text)
            if len(m[0]) >= 32]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text: str | None) -> tuple[int, int, int, int, int, bool]:
    text = text or ""
    w = words(text)
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    times = Counter(windows)
    repeated = {k + j for k, x in enumerate(windows) if times[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(repeated), failed)


def best_weight(word: str, pieces) -> int:
    """Least weight over all ways to cut a word, by trying them all."""
    if not word:
        return 0
    found = []
    for n in range(1, len(word) + 1):
        piece = pieces.table.get(word[:n])
        if piece is None and n == 1:
            piece = (-1, pieces.weight_of_bytes(word[0]))
        if piece is not None:
            found.append(piece[1] + best_weight(word[n:], pieces))
    return min(found)


def best_weight_forward(word: str, pieces) -> tuple[int, int]:
    """Least (weight, pieces) from left to right over all starts, weight and count apart."""
    scale = 1 << 32
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        ways = []
        for start in range(max(0, end - 64), end):
            piece = pieces.table.get(word[start:end])
            if piece is not None:
                ways.append((best[start][0] + piece[1] // scale, best[start][1] + 1))
            elif start == end - 1:
                size = len(word[start].encode())
                ways.append((best[start][0] + size * (pieces.byte_weight // scale), best[start][1] + size))
        best.append(min(ways))
    return best[-1]


def bm25_shares(items: dict[int, list[bytes]], passage: set[bytes], k1: float, b: float
                ) -> dict[int, float]:
    df = Counter(t for w in items.values() for t in set(w))
    mean = sum(map(len, items.values())) / len(items)
    out = {}
    for i, w in items.items():
        weights = {}
        for t, tf in Counter(w).items():
            idf = math.log(1 + (len(items) - df[t] + 0.5) / (df[t] + 0.5))
            weights[t] = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(w) / mean))
        out[i] = sum(v for t, v in weights.items() if t in passage) / sum(weights.values())
    return out
