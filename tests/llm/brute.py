"""Plain versions of the operators' contracts, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def repeats(units: list, width: int, keep_first: bool = False) -> list[list[bool]]:
    """Which units of each sequence are covered by a window that also starts elsewhere (earlier)."""
    where = collections.defaultdict(list)
    for i, u in enumerate(units):
        for k in range(len(u) - width + 1):
            where[tuple(u[k : k + width])].append((i, k))
    gone = [[False] * len(u) for u in units]
    for places in where.values():
        for i, k in places[1:] if keep_first else places if len(places) > 1 else []:
            gone[i][k : k + width] = [True] * width
    return gone


def shingles(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def groups(rows: list[tuple]) -> list[int]:
    """A component number for each row."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = label[i], label[j]
                label = [min(x, y) if v in (x, y) else v for v in label]
    return label


def components(rows: list[tuple]) -> dict:
    """Row number -> smallest doc_id reachable (null ids name nothing)."""
    sets, label = [shingles(t) for _, t in rows], groups(rows)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[label[i]] = min(doc_id, least.get(label[i], doc_id))
    return {i: rows[i][0] if not sets[i] else least.get(label[i]) for i in range(len(rows))}


def quality(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    cover = {k + d for k, g in enumerate(zip(w, w[1:], w[2:])) if seen[g] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover)


def licenses(text: str | None) -> tuple:
    base = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit"}
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    hits = [(k, label) for p, label in base.items() for k in range(len(w) - len(p) + 1) if tuple(w[k : k + len(p)]) == p]
    at = [k for k, _ in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))
