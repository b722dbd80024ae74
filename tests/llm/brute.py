"""Plain single-machine versions of the contracts, for comparison."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingle_set(text, width):
    w = WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def near_duplicates(docs, width, percent=80):
    """``(doc_id, n_shingles, component_id, kept)`` by comparing texts that share a shingle."""
    sets = {d: shingle_set(t, width) for d, t in docs}
    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d, s in sets.items():
        common = {}
        for x in s:
            for e in holders[x]:
                if e < d:
                    common[e] = common.get(e, 0) + 1
        for e, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                parent[b] = a
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets.items())


def repeats(docs, width):
    """``(doc_id, n_words, n_removed, kept_sha256)`` with windows as tuples."""
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, (x[1] or "").encode())):
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            if key in seen:
                gone |= set(range(i, i + width))
            seen.add(key)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)
