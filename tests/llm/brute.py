"""Brute-force versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Sets:
    """Union of sets, each named by its smallest member."""

    def __init__(self, members) -> None:
        self.name = {m: m for m in members}

    def find(self, x):
        while self.name[x] != x:
            self.name[x] = x = self.name[self.name[x]]
        return x

    def join(self, x, y) -> None:
        x, y = sorted((self.find(x), self.find(y)))
        self.name[y] = x


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def majority(hashes: list[int]) -> int:
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def fingerprint(text: str | None) -> int:
    low = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
    if not low:
        return 0
    shingles = [b" ".join(low[i : i + 3]) for i in range(max(1, len(low) - 2))]
    return majority([xxhash.xxh64_intdigest(s, seed=42) for s in shingles])


def simhash_groups(texts: list[str | None], apart: int = 2) -> tuple[list[int], Sets]:
    prints = [fingerprint(t) for t in texts]
    sets = Sets(range(len(texts)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= apart:
                sets.join(i, j)
    return prints, sets


def edits(a: list, b: list) -> int:
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def normalised(line: str) -> str:
    return re.sub(r"[!-/:-@\[-`{-~ \t\n\x0B\f\r]+", " ", line.lower()).strip(" ")


def line_fingerprint(words_: list[str]) -> int:
    """Of 20-bit hashes of the words."""
    codes = [(xxhash.xxh64_intdigest(w.encode(), seed=42) & 0xFFFFF) + 0x10000 for w in words_]
    return majority([xxhash.xxh64_intdigest(code.to_bytes(4, "little"), seed=42) for code in codes])


def without_repeated_lines(texts: list[str | None], apart: int = 14, similarity: float = 0.8) -> list[str | None]:
    places = defaultdict(list)
    for i, text in enumerate(texts):
        for j, line in enumerate((text or "").split("\n")):
            if text is not None and normalised(line):
                places[normalised(line)].append((i, j))
    lines = list(places)
    cut = [line.split(" ") for line in lines]
    prints = np.array([line_fingerprint(ws) for ws in cut], np.uint64)
    sets = Sets(range(len(lines)))
    for i in range(len(lines)):
        for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= apart).tolist():
            if edits(cut[i], cut[j]) <= int(max(len(cut[i]), len(cut[j])) * (1 - similarity) + 1e-9):
                sets.join(i, j)
    groups = defaultdict(list)
    for i, line in enumerate(lines):
        groups[sets.find(i)] += places[line]
    gone = {place for own in groups.values() for place in own if place != min(own)}
    return [
        None if text is None else "\n".join(l for j, l in enumerate(text.split("\n")) if (i, j) not in gone)
        for i, text in enumerate(texts)
    ]


def shares(sizes: dict, weights: dict, cap: float) -> dict:
    """Targets by handing the excess round until nothing is above its limit."""
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        weight = sum(weights[s] for s in sizes if s not in full)
        made = {s: cap * sizes[s] if s in full else weights[s] * rest / weight for s in sizes}
        over = {s for s in sizes if s not in full and made[s] > cap * sizes[s]}
        if not over:
            return made
        full |= over


def seats(shares_: list[float], house: int) -> list[int]:
    """Seats one by one to the highest quotient, the first of equals."""
    got = [0] * len(shares_)
    for _ in range(house):
        best = max(range(len(shares_)), key=lambda i: (shares_[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


def components(count: int, links) -> Sets:
    sets = Sets(range(count))
    for a, b in links:
        sets.join(int(a), int(b))
    return sets


def best_pieces(pieces: dict[str, float], unknown: float, text: str) -> float:
    """Score of the best path over a whole marked text."""
    best = [0.0] + [-np.inf] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + 16) + 1):
            score = pieces.get(text[i:j], unknown if j == i + 1 else None)
            if score is not None:
                best[j] = max(best[j], best[i] + score)
    return best[-1]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
