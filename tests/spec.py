"""Sequential specifications, independent of the engine, that its set forms are held against."""

from collections import Counter, defaultdict
from urllib.parse import parse_qs, urlencode, urlparse, urlunparse


def param_set(query):
    return sorted(urlencode([item], True) for item in parse_qs(query).items())


def simplify(url, black=()):
    p = urlparse(url)
    if not p.query:
        return url
    return urlunparse((p.scheme, p.netloc, p.path, p.params, "&".join(sorted(set(param_set(p.query)) - set(black))), ""))


def admission(arrivals, known, black=()):
    """Queue and field after clean URLs arrive one by one."""
    field, queue = {u: None for u in known}, []
    for u in arrivals:
        if u in field:
            continue
        field[u] = False
        s = simplify(u, black)
        if s != u:
            if s in field:
                field[u] = True
                continue
            field[s] = True
        queue.append(u)
    return queue, field


def novelty(urls, split):
    seen, out = Counter(), []
    for u in urls:
        parts = [x for x in split(u)[1:] if x]
        score = 1
        for i in range(1, len(parts)):
            score += i * seen[tuple(parts[:i])]
            seen[tuple(parts[:i])] += 1
        out.append(score * (100 if "?" in u else 1))
    return out


def bfs(nodes, roots, edges):
    depth, level, d = dict.fromkeys(roots, 0), set(roots), 0
    while level:
        d += 1
        level = {b for a, b in edges if a in level and b in nodes and b not in depth}
        depth.update(dict.fromkeys(level, d))
    return {n: depth.get(n) for n in nodes}


def path_yield(nodes, edges, depth, targets):
    out = dict.fromkeys(nodes, 0.0)
    for t in targets:
        level = {t}
        for d in range(depth[t], 0, -1):
            for n in level:
                out[n] += 1 / len(level)
            level = {a for a, b in edges if b in level and depth.get(a) == d - 1}
    return out


def components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in parent}


def pair_scores(groups):
    agree, differ = Counter(), Counter()
    for members in groups:
        for i, p in enumerate(members):
            for q in members[i + 1 :]:
                if p != q:
                    for x in p | q:
                        (agree if x in p and x in q else differ)[x] += 1
    return {x: (agree[x], differ[x]) for x in agree | differ}


def purge_sets(sets, ids):
    """Remove ids one at a time from {to_set: from_set}."""
    for i in ids:
        out = defaultdict(set)
        for to, frm in sets.items():
            left_to, left_from = tuple(x for x in to if x != i), frm - {i}
            if left_to and left_from:
                out[left_to] |= left_from
        sets = out
    return {k: sorted(v) for k, v in sets.items()}


def volumes(sizes, threshold):
    out, total, volume = [], 0, 1
    for s in sizes:
        out.append(volume)
        total += s
        if total > threshold:
            total, volume = 0, volume + 1
    return out
