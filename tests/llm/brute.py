"""Plain Python versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def contamination(documents, benchmark):
    """{row number: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows: dict[tuple, set] = {}
    for item, text in benchmark:
        ws = words(text)
        n = min(13, len(ws))
        for i in range(len(ws) - n + 1 if ws else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    rows = []
    for doc_id, text in documents:
        ws, hit, items = words(text), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                found = windows.get(tuple(ws[i : i + n]))
                if found is not None:
                    hit |= set(range(i, i + n))
                    items |= found
        ids = sorted(str(x) for x in items if x is not None)
        bad = len(hit) > 0 and 20 * len(hit) >= len(ws)
        rows.append((doc_id, len(ws), len(hit), len(ids), sha(",".join(ids)), bad))
    return rows


def labelled(text: str | None) -> list[tuple]:
    ws = words(text)
    k = min(5, len(ws))
    seen: Counter = Counter()
    out = []
    for i in range(len(ws) - k + 1 if ws else 0):
        shingle = tuple(ws[i : i + k])
        out.append((shingle, seen[shingle]))
        seen[shingle] += 1
    return out


def aligned(a: list, b: list) -> float:
    """In-order shared shingles, by the textbook table, against all shingles of both."""
    if not a or not b:
        return 0.0
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1] / (len(a) + len(b) - row[-1])


def classes(documents, threshold=0.8):
    """Smallest id of the near-duplicate class of each (doc_id, text)."""
    shingles = [labelled(text) for _, text in documents]
    parent = list(range(len(documents)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(shingles):
        for j in range(i):
            b = shingles[j]
            if a and b and len(set(a) & set(b)) >= threshold * min(len(a), len(b)) and aligned(a, b) >= threshold:
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(documents):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [least[root(i)] for i in range(len(documents))]


BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
]


def base_spans(text: str | None) -> list[tuple[int, str, int]]:
    found = []
    for place, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            size = len(m[2]) if kind == "assign" else m.end() - m.start()
            if size >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                found.append((m.start(), place, kind, m.end()))
    return [(start, kind, end) for start, _, kind, end in sorted(found)]
