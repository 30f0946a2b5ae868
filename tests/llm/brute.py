"""Plain Python versions of the operators, for small fixtures."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def repeated_strings(rows, depth):
    """[(doc_id, n_bytes, n_removed, n_spans, kept bytes, spans)] of (doc_id, text)."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + depth] for t in texts for i in range(len(t) - depth + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - depth + 1):
            if seen[t[i : i + depth]] > 1:
                gone[i : i + depth] = b"\1" * depth
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        pieces = "".join(t[m.start() : m.end()].decode("utf-8", "ignore") for m in re.finditer(b"\0+", bytes(gone)))
        out.append((doc, len(t), len(t) - len(kept), spans, sha(kept), pieces))
    return out


def repeated_windows(rows, size):
    first = {}
    big = float("inf")
    for doc, t in rows:
        w = words(t)
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, big), big if doc is None else doc)
    out = []
    for doc, t in rows:
        w, gone = words(t), set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < (big if doc is None else doc):
                gone.update(range(i, i + size))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def shingles(text):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def classes(rows):
    """For each row, the number of the first row that links reach."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(rows))], [len(s) for s in sets]


def components(rows):
    """[(doc_id, n_shingles, component_id)]"""
    root, sizes = classes(rows)
    groups = defaultdict(list)
    for (doc, _), r in zip(rows, root):
        groups[r].append(doc)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return [(doc, n, least[r]) for (doc, _), n, r in zip(rows, sizes, root)]


def statistics(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeat = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(repeat),
        len(lines),
        sum(a == b for a, b in zip(w, w[1:])),
    )
