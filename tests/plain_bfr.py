"""Plain BFR on Python lists, written from the rules, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import math


def priority(seed, row_id):
    return hashlib.md5(f"{seed}:{row_id}".encode()).hexdigest(), row_id


def euclid(a, b):
    return math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))


def scaled(a, b, sd):
    total = 0.0
    for x, y, s in zip(a, b, sd):
        if s == 0:
            if x != y:
                return math.inf
        else:
            total += ((x - y) / s) ** 2
    return math.sqrt(total)


class Cluster:
    def __init__(self, vectors):
        d = len(vectors[0])
        self.n = len(vectors)
        self.s = [sum(v[i] for v in vectors) for i in range(d)]
        self.q = [sum(v[i] ** 2 for v in vectors) for i in range(d)]

    def merge(self, other):
        self.n += other.n
        self.s = [a + b for a, b in zip(self.s, other.s)]
        self.q = [a + b for a, b in zip(self.q, other.q)]

    @property
    def mean(self):
        return [x / self.n for x in self.s]

    @property
    def sd(self):
        return [math.sqrt(max(q / self.n - (s / self.n) ** 2, 0.0)) for s, q in zip(self.s, self.q)]


def kmeans(points, k, rounds, seed, tol=1e-4):
    """Members of each cluster in the last round, as lists of ids."""
    start = sorted(points, key=lambda i: priority(seed, i))[:k]
    centre = [list(points[i]) for i in start]
    members = []
    for _ in range(rounds):
        if not centre:
            break
        members = [[] for _ in centre]
        for i, v in points.items():
            gaps = [euclid(v, c) for c in centre]
            members[gaps.index(min(gaps))].append(i)
        moved = [Cluster([points[i] for i in m]).mean if m else c for m, c in zip(members, centre)]
        shift = max(abs(a - b) for c, m in zip(centre, moved) for a, b in zip(c, m))
        centre = moved
        if shift < tol:
            break
    return members


def nearest(v, clusters, limit):
    best, gap = None, math.inf
    for key, c in clusters.items():
        d = scaled(v, c.mean, c.sd)
        if d < limit and d < gap:
            best, gap = key, d
    return best


def bfr(chunks, k, alpha, seed=666, match="first", assign_first=False):
    """``chunks``: list of dicts id to vector. Returns labels and round records."""
    ds, cs, owner, rs, records, fresh = {}, {}, {}, {}, [], 0
    for number, chunk in enumerate(chunks):
        d = len(next(iter(chunk.values())))
        limit = alpha * math.sqrt(d)
        rest = dict(chunk)
        if number == 0:
            first = 10_000 if len(chunk) > 10_000 else int(len(chunk) * 0.1)
            sample = {i: v for i, v in chunk.items() if i < first}
            rest = {i: v for i, v in chunk.items() if i >= first}
            for key, ids in enumerate(kmeans(sample, k, 5, seed)):
                ds[key] = Cluster([sample[i] for i in ids])
                owner.update({i: key for i in ids})
            fresh = len(ds)
        if number > 0 or assign_first:
            placed, left = {}, {}
            for i, v in rest.items():
                key = nearest(v, ds, limit)
                key = nearest(v, cs, limit) if key is None else key
                if key is None:
                    left[i] = v
                else:
                    placed.setdefault(key, []).append(i)
            for key, ids in placed.items():
                (ds if key in ds else cs)[key].merge(Cluster([rest[i] for i in ids]))
                owner.update({i: key for i in ids})
            rest = left
        pool = {**rest, **rs}
        rs = {}
        for ids in kmeans(pool, 3 * k, 3 if number == 0 else 5, seed):
            if len(ids) == 1:
                rs[ids[0]] = pool[ids[0]]
            elif ids:
                cs[fresh] = Cluster([pool[i] for i in ids])
                owner.update({i: fresh for i in ids})
                fresh += 1
        if number > 0:
            keys, used, merged = list(cs), set(), []
            for x, a in enumerate(keys):
                for b in keys[x + 1 :]:
                    if a in used or b in used:
                        continue
                    if scaled(cs[a].mean, cs[b].mean, cs[a].sd) < limit:
                        used |= {a, b}
                        merged.append((a, b))
            for a, b in merged:
                both = cs.pop(a)
                both.merge(cs.pop(b))
                cs[fresh] = both
                owner.update({i: fresh for i, o in owner.items() if o in (a, b)})
                fresh += 1
        if number + 1 == len(chunks):
            fixed = {key: (c.mean, c.sd) for key, c in ds.items()}
            for a in list(cs):
                gaps = {key: scaled(cs[a].mean, m, sd) for key, (m, sd) in fixed.items()}
                fits = [key for key in gaps if gaps[key] < limit]
                if fits:
                    to = fits[0] if match == "first" else min(fits, key=lambda key: gaps[key])
                    ds[to].merge(cs.pop(a))
                    owner.update({i: to for i, o in owner.items() if o == a})
        records.append((
            number + 1, len(ds), sum(c.n for c in ds.values()),
            len(cs), sum(c.n for c in cs.values()), len(rs),
        ))
    labels = {i: (key if key in ds else -1) for i, key in owner.items()}
    labels.update({i: -1 for i in rs})
    return labels, records
