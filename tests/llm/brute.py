"""Plain versions of the operators, one document or one pair at a time."""

import hashlib
import itertools
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

BASE = (("assign", re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 6),
        ("access", re.compile(r"(AKIA[A-Z0-9]+)"), 20), ("hex", re.compile(r"([0-9a-f]+)"), 24))


def secrets(text):
    out = [(m.start(), k, m.end()) for k, (_, rx, least) in enumerate(BASE) for m in rx.finditer(text or "") if len(m[1]) >= least]
    spans = [f"{BASE[k][0]}:{a}:{b}" for a, k, b in sorted(out)]
    return [sum(k == i for _, k, _ in out) for i in range(3)], hashlib.sha256(",".join(spans).encode()).hexdigest(), spans


def shingles(text, k=3, lower=True):
    words = WORD.findall((text or "").translate(LOWER) if lower else text or "")
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def jaccard_components(rows, k=3):
    """{(doc_id, text): (set size, component)} by comparing all pairs that share a shingle."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    pairs = {p for m in by.values() for p in itertools.combinations(m, 2)}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[find(i)].append(doc)
    return {row: (len(sets[i]), min((x for x in ids[find(i)] if x is not None), default=None)) for i, row in enumerate(rows)}


def line_windows(rows):
    """{(doc_id, text): text left} after removing later occurrences of three-line windows."""
    seen, out = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        lines = [] if text is None else text.split("\n")
        full = [i for i, s in enumerate(lines) if s.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for at in zip(full, full[1:], full[2:]):
            key = tuple(lines[i].strip(" \t\n\x0b\x0c\r") for i in at)
            if seen.setdefault(key, (doc, text, at[0])) != (doc, text, at[0]):
                gone |= set(at)
        kept = [s for i, s in enumerate(lines) if i not in gone]
        left = text if not gone else "\n".join(kept) if any(s.strip(" \t\n\x0b\x0c\r") for s in kept) else ""
        out[doc, text] = left
    return out


def kept_of_near_copies(data, k=5, num=8, den=10):
    """Smallest doc_id of every component, by comparing all pairs that share a shingle."""
    sets = [shingles(t, k) for _, t in data]
    parent = list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    for a, b in {p for m in by.values() for p in itertools.combinations(m, 2)}:
        both = len(sets[a] & sets[b])
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(data):
        ids[find(i)].append(doc)
    return sorted(min(v) for v in ids.values())
