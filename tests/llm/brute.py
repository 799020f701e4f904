"""Plain versions of what the operators compute, for small inputs."""

from collections import Counter, defaultdict


def shingles(text, n):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = data.split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def near_components(rows, n, percent=80):
    """Index of each row's component: all pairs that share a shingle are compared in full."""
    sets = [shingles(r.text, n) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, s in enumerate(sets):
        for j, shared in Counter(j for x in s for j in index[x]).items():
            if 100 * shared >= percent * (len(s) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
        for x in s:
            index[x].append(i)
    return [find(i) for i in range(len(rows))], [len(s) for s in sets]


def norm(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
