"""The plain ways to the same results."""

import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return [w.lower() for w in WORD.findall((text or "").encode())]


def grams(text, size=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def similar(docs, percent=75):
    """Component of each document by shingle similarity, over all pairs."""
    sets = {i: grams(t) for i, t in docs.items()}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return sets, components(ids, links)


def repeated(docs, size):
    """Ids of documents that share a run of ``size`` words with another one."""
    where = {}
    for i, text in docs.items():
        w = words(text)
        for k in range(len(w) - size + 1):
            where.setdefault(tuple(w[k:k + size]), set()).add(i)
    return {i for ids in where.values() if len(ids) > 1 for i in ids}
