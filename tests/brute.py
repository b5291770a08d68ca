"""Plain-Python models of the semantics, for comparison on small graphs."""

from __future__ import annotations

TOPICS = ("games", "movies", "music")


def users_of(edges):
    return sorted({u for e in edges for u in e})


def pagerank(edges, k=10, d=0.85):
    users = users_of(edges)
    n = len(users)
    out = {u: [] for u in users}
    for s, t in edges:
        out[s].append(t)
    rank = {u: 1.0 / n for u in users}
    for _ in range(k):
        recv = {u: 0.0 for u in users}
        for s, ts in out.items():
            for t in ts:
                recv[t] += rank[s] / len(ts)
        mass = sum(rank[u] for u in users if not out[u])
        rank = {u: (1 - d) / n + d * (recv[u] + mass / n) for u in users}
    return rank


def recommendations(edges, topics, k=10, threshold=3.0):
    """Full-state rounds exactly as specified: every receiver, every topic."""
    users = users_of(edges)
    tmap = {r[0]: r[1:] for r in topics}
    freq = {(u, t): (tmap[u][i] if u in tmap else 0.0) for u in users for i, t in enumerate(TOPICS)}
    inter = {key: f >= threshold for key, f in freq.items()}
    best = {key: (f, key[0]) for key, f in freq.items()}
    dedup = sorted(set(edges))
    for _ in range(k):
        offers = {}
        for s, t in dedup:
            for topic in TOPICS:
                if inter[(s, topic)]:
                    o = best[(s, topic)]
                    cur = offers.get((t, topic))
                    if cur is None or o > cur:
                        offers[(t, topic)] = o
        nxt = dict(best)
        for key, (f, u) in offers.items():
            if f > best[key][0]:
                nxt[key] = (f, u)
        best = nxt
    out = {}
    for u in users:
        cands = [(best[(u, t)][0], -best[(u, t)][1], best[(u, t)][1], t) for t in TOPICS if inter[(u, t)]]
        if cands:
            c = max(cands)
            if c[0] > 0:
                out[u] = (c[2], c[0], c[3])
    return out
