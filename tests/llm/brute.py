"""Plain versions that the operators are compared with."""

import hashlib
import itertools

from themelake.llm.bottomk_dedup import shingle_set


def components(docs, words, percent):
    """(doc_id, text) pairs with distinct ids -> doc_id: (set size, component), all pairs compared."""
    sets = {d: shingle_set((t or "").encode(), words) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def repeats(docs, length=50):
    """(doc_id, text) pairs -> list of (doc_id, bytes, removed, spans, digest, covered) in the order given."""
    docs = [(d, (t or "").encode()) for d, t in docs]
    smallest = {}
    for d, t in docs:
        if d is not None:
            for i in range(len(t) - length + 1):
                s = t[i : i + length]
                smallest[s] = min(smallest.get(s, d), d)
    out = []
    for d, t in docs:
        covered = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if d is not None and smallest[t[i : i + length]] < d:
                covered[i : i + length] = b"\1" * length
        kept = bytes(b for b, c in zip(t, covered, strict=True) if not c)
        spans = bytes(covered).count(b"\0\1") + (covered[:1] == b"\1")
        out.append((d, len(t), sum(covered), spans, hashlib.sha256(kept).hexdigest(), bytes(covered)))
    return out
