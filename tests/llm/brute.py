"""Plain one-machine versions of the operators' results, for small inputs."""

import hashlib
from collections import defaultdict


def split(text):
    """Words of [^\\x20\\x09-\\x0D]+."""
    return [w.decode() for w in (text or "").encode().split()]


def shingles(text, k=5):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def components(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(docs, percent=85):
    """{doc_id: (n_shingles, component_id, kept)} of (doc_id, text) with distinct ids."""
    sets = {d: shingles(t) for d, t in docs}
    ids = sorted(d for d in sets if sets[d])
    links = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                links.append((a, b))
    comp = components(list(sets), links)
    return {d: (len(sets[d]), comp[d], comp[d] == d) for d in sets}


def cut_repeats(docs, window=20):
    """{doc_id: (n_words, n_removed, kept text)} of (doc_id, text) with distinct ids."""
    seen, gone, words = set(), defaultdict(set), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        words[d] = w = split(t)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                gone[d].update(range(i, i + window))
            seen.add(key)
    return {d: (len(w), len(gone[d]), " ".join(x for i, x in enumerate(w) if i not in gone[d])) for d, w in words.items()}


def water_fill(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """{source: target}: the budget by weight, capped, the excess dealt again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if budget * w[s] / total >= most * sizes[s]}
        if not over:
            target.update({s: budget * w[s] / total for s in open_})
            break
        for s in over:
            target[s] = float(most * sizes[s])
            budget -= target[s]
        open_ -= over
    return target


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
