"""Plain versions of the operators, for small inputs."""

import hashlib
import re


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def without_copies(docs, units, length):
    """docs: (id, text); units: text to list. Per row: units, removed flags."""
    first = {}
    ids = [float("inf") if i is None else i for i, _ in docs]
    split = [units(t) for _, t in docs]
    for i, u in zip(ids, split):
        for k in range(len(u) - length + 1):
            w = tuple(u[k : k + length])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, u in zip(ids, split):
        gone = [False] * len(u)
        for k in range(len(u) - length + 1):
            if first[tuple(u[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        out.append((u, gone))
    return out


def phrases(docs, length=13):
    rows = []
    for (i, _), (u, gone) in zip(docs, without_copies(docs, words_of, length)):
        kept = " ".join(w for w, g in zip(u, gone) if not g)
        rows.append((i, len(u), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return rows


def strings(docs, length=50):
    rows = []
    for (i, _), (u, gone) in zip(docs, without_copies(docs, lambda t: list((t or "").encode()), length)):
        kept = bytes(b for b, g in zip(u, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        rows.append((i, len(u), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return rows


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def probability_jaccard(x, y):
    total = 0.0
    for i in x.keys() & y.keys():
        total += 1.0 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys())
    return total


def weighted(text, words=5):
    import math
    from collections import Counter

    w = words_of((text or "").lower())
    n = min(words, len(w))
    counts = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else {}
    return {k: 1 + math.log(c) for k, c in counts.items()}


def near_duplicates(docs, threshold=0.8):
    """docs: (id, text). Per row: id, smallest id of its class."""
    sets = [weighted(t) for _, t in docs]
    where = {}
    for i, s in enumerate(sets):
        for k in s:
            where.setdefault(k, []).append(i)
    links = set()
    for i, s in enumerate(sets):
        for j in {j for k in s for j in where[k] if j > i}:
            a, b = s, sets[j]
            if a == b or (len(a.keys() & b.keys()) >= 0.5 * max(len(a), len(b)) * threshold and probability_jaccard(a, b) >= threshold):
                links.add((i, j))
    root = components(len(docs), links)
    big = float("inf")
    least = {}
    for (i, _), r in zip(docs, root):
        least[r] = min(least.get(r, big), big if i is None else i)
    return [(i, None if least[r] == big else least[r]) for (i, _), r in zip(docs, root)]


def all_line_classes(docs, size=4):
    """Per line that is not blank: id, place, id and place of the first of its component, by strings of ``size``
    letters. Lines without one have only copies."""
    at = [(i, p, line.lower().strip(" \t\r\v\f")) for i, text in docs for p, line in enumerate((text or "").split("\n"))]
    at = [x for x in at if x[2]]
    lines = sorted({x[2] for x in at})
    sets = [{x[k : k + size] for k in range(len(x) - size + 1)} for x in lines]
    where = {}
    for n, s in enumerate(sets):
        for k in s:
            where.setdefault(k, []).append(n)
    links = []
    for n, s in enumerate(sets):
        hits = {}
        for k in s:
            for m in where[k]:
                if m > n:
                    hits[m] = hits.get(m, 0) + 1
        links += [(n, m) for m, c in hits.items() if c / (len(s) + len(sets[m]) - c) >= 0.8]
    root = dict(zip(lines, components(len(lines), links)))
    first = {}
    for i, p, line in at:
        first[root[line]] = min(first.get(root[line], (i, p)), (i, p))
    return [(i, p, *first[root[line]]) for i, p, line in at]
