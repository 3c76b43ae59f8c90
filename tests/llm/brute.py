"""Plain Python versions of the operators, over a list of (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingle_set(text: str | None, k: int = 5) -> set[tuple[str, ...]]:
    w = words((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def ngram_components(docs: list[tuple[int, str | None]], percent: int = 80) -> list[tuple[int, int, int]]:
    sets = [shingle_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(a: int) -> int:
        while root[a] != a:
            a = root[a]
        return a

    held = defaultdict(list)
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in held[g]).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for g in s:
            held[g].append(i)
    low: dict[int, int] = {}
    for i, (d, _) in enumerate(docs):
        low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(docs)]


def substring_dedup(docs: list[tuple[int | None, str | None]], window: int = 50) -> list[tuple]:
    first: dict[tuple, int] = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((d, len(w), len(w) - len(kept), sha(" ".join(kept))))
    return out


def edits_within(a: str, b: str, most: int) -> bool:
    if abs(len(a) - len(b)) > most:
        return False
    row = {j: j for j in range(min(len(b), most) + 1)}
    for i in range(1, len(a) + 1):
        new: dict[int, int] = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            new[j] = i if j == 0 else min(row.get(j - 1, 99) + (a[i - 1] != b[j - 1]), row.get(j, 99) + 1, new.get(j - 1, 99) + 1)
        row = new
        if min(row.values()) > most:
            return False
    return row.get(len(b), 99) <= most


def line_dedup(docs: list[tuple[int, str | None]], edits: int = 2, min_chars: int = 20, chars_per_edit: int = 20) -> list[tuple]:
    """One edit for each ``chars_per_edit`` characters of the longer line, at least ``edits``."""
    first: dict[str, tuple] = {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        for i, x in enumerate((t or "").split("\n")):
            if WORD.search(x):
                first.setdefault(x, (d, i))
    by_length = defaultdict(list)
    for x in first:
        if len(x) >= min_chars:
            by_length[len(x)].append(x)
    near = set()
    for n, same in list(by_length.items()):
        for a in same:
            # Only lines up to m = n + m / chars_per_edit characters can be near.
            for m in range(n, n + max(edits, n // (chars_per_edit - 1)) + 1):
                for b in by_length.get(m, []):
                    if a != b and edits_within(a, b, max(edits, m // chars_per_edit)):
                        near.add(max(a, b, key=first.__getitem__))
    out = []
    for d, t in docs:
        lines = [] if t is None else t.split("\n")
        kept = [x for i, x in enumerate(lines) if not WORD.search(x) or (first[x] == (d, i) and x not in near)]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(x: str) -> str:
    return re.sub(r"[^0-9]", "", x)


def _luhn(x: str) -> bool:
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(x))) % 10 == 0


def personal(text: str | None) -> list[str]:
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in _EMAIL.finditer(t)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in _CARD.finditer(t) if 14 <= len(_digits(m[0])) <= 19 and _luhn(_digits(m[0]))]
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(t) if 10 <= len(_digits(m[0])) <= 15]
    return [f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in sorted(found)]
