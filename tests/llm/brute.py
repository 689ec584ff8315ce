"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def words(text, lower=False):
    raw = (text or "").encode()
    return WORD.findall(raw.lower() if lower else raw)


def shingles(text, n=4):
    w = words(text, True)
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def linked(rows, n=4):
    sets = [shingles(t, n) for _, t in rows]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            if 100 * min(len(sets[i]), len(sets[j])) < 85 * max(len(sets[i]), len(sets[j])):
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((a, len(s), find(a) if a is not None else None) for (a, _), s in zip(rows, sets)), key=str)


def without_repeats(rows, k=13):
    first, held = {}, []
    for i, t in rows:
        w = words(t)
        held.append(w)
        for p in range(len(w) - k + 1):
            g = b" ".join(w[p:p + k])
            if i is not None and first.get(g, i) >= i:
                first[g] = i
    out = []
    for (i, _), w in zip(rows, held):
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            if i is not None and first[b" ".join(w[p:p + k])] < i:
                gone[p:p + k] = [True] * k
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def base_scores(rows):
    """{doc_id: (held out, tokens, known, N, base score)}."""
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    tokens = [[*words(t, True), None] for _, t in rows]
    count = Counter(w for (i, _), x in zip(rows, tokens) if not held(i) for w in x)
    n, v = sum(count.values()), len(count)
    return [(i, held(i), len(x), sum(count[w] > 0 for w in x), n, sum(math.log10((count[w] + .1) / (n + .1 * (v + 1))) for w in x)) for (i, _), x in zip(rows, tokens)]


def plain(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def exact_items(rows, items):
    """(doc_id, item_id) of items whose words stand in a text one after the other."""
    starts = defaultdict(list)
    for i, t in items:
        w = plain(t)
        starts[w[0]].append((i, w))
    out = set()
    for d, t in rows:
        w = plain(t)
        for p, x in enumerate(w):
            out.update((d, i) for i, q in starts.get(x, ()) if w[p:p + len(q)] == q)
    return out
