"""Plain, slow versions of the operators' results, one document at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def lower(text: str) -> str:
    return text.translate(UPPER)


def quality(text: str | None) -> dict:
    text = text or ""
    found = WORD.findall(text)
    runs = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    hit = set()
    for i in range(len(found) - 7):
        if runs[tuple(found[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(found),
        "word_chars": sum(map(len, found)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "base_failed": len(found) < 20 or 100 * len(hit) > 30 * len(found),
    }


def shingles(text: str | None, length: int = 3) -> frozenset:
    found = WORD.findall(lower(text or ""))
    if len(found) < length:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + length]) for i in range(len(found) - length + 1))


def near(docs: list[tuple[int, str | None]], length: int = 3, percent: int = 90) -> dict[int, tuple[int, int]]:
    sets = [(i, shingles(t, length)) for i, t in docs]
    up = {i: i for i, _ in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = root(i), root(j)
                    up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets}


def overlaps(docs, items, length=13) -> list[tuple]:
    windows: dict[tuple, set] = {}
    for item, text in items:
        found = TERM.findall(lower(text or ""))
        for i in range(max(1, len(found) - length + 1) if found else 0):
            windows.setdefault(tuple(found[i : i + length]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        found = TERM.findall(lower(text or ""))
        hit, got = set(), set()
        for n in sizes:
            for i in range(len(found) - n + 1):
                if (w := tuple(found[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    got |= windows[w]
        digest = hashlib.sha256(",".join(sorted(got)).encode()).hexdigest()
        out.append((doc, len(found), len(hit), len(got), digest, bool(hit) and 20 * len(hit) >= len(found)))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text: str | None) -> tuple:
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [
        [m for m in EMAIL.finditer(text)],
        [m for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
        [m for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        [m for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    ]
    kinds = ("email", "ip", "card", "phone")
    line = ",".join(f"{k}:{m.start()}:{m.end()}" for k, ms in zip(kinds, found) for m in ms)
    return (*map(len, found), hashlib.sha256(line.encode()).hexdigest(), line)


PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def licenses(text: str | None) -> tuple:
    found = TERM.findall(lower(text or ""))
    places = sorted(
        (i, label) for words, label in PHRASES.items() for i in range(len(found)) if tuple(found[i : i + len(words)]) == words
    )
    at = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(found), len(at), min(at, default=None), max(at, default=None), labels


def archived(pages: list[tuple[int, str | None]]) -> list[tuple]:
    payloads = [(i, (h or "").encode()) for i, h in pages]
    largest: dict[bytes, int] = {}
    for i, p in payloads:
        if len(p) >= 1000:
            largest[p] = max(largest.get(p, i), i)
    out = []
    for i, p in payloads:
        again = p in largest and largest[p] != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", largest[p] if again else None))
    return out


def pieces(docs, tokenizer, capacity=4096) -> list[tuple]:
    import zlib

    import numpy as np

    out = []
    for doc, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            out.append((doc, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return out


def gapless(places: list[tuple[int, int, int]], capacity=4096) -> bool:
    """Whether (sequence, offset, length) fill each sequence from 0 without gaps and within ``capacity``."""
    ends: dict[int, int] = {}
    for sequence, offset, length in sorted(places):
        if offset != ends.get(sequence, 0):
            return False
        ends[sequence] = offset + length
    return max(ends.values(), default=0) <= capacity
