"""Plain versions that the pipeline is held against."""

from __future__ import annotations

from collections import defaultdict


def components(rows):
    """doc -> smallest id reachable over links of Jaccard 0.75 on five-word shingles."""
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for d in sorted(sets):
        for g in sets[d]:
            holders[g].append(d)
    for d, s in sets.items():
        for o in {o for g in s for o in holders[g] if o < d}:
            both = len(s & sets[o])
            if 100 * both >= 75 * (len(s) + len(sets[o]) - both):
                a, b = sorted((root(d), root(o)))
                parent[b] = a
    return {d: root(d) for d in sets}


def repeated(rows, n=50):
    """doc -> text without the bytes of n-byte strings that a smaller document has."""
    first: dict = {}
    out = {}
    for doc, text in sorted(rows):
        data = text.encode()
        gone = bytearray(len(data))
        for at in range(len(data) - n + 1):
            if first.setdefault(data[at:at + n], doc) < doc:
                gone[at:at + n] = b"\1" * n
        out[doc] = bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore")
    return out
