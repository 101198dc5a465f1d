"""Brute-force versions that the operators are compared with."""

import collections

WORDS = b" \t\n\x0b\x0c\r"


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, size):
    w = words(text)
    return [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([b" ".join(w)] if w else [])


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def components(nodes, links):
    """Smallest reachable node per node."""
    label = {n: n for n in nodes}
    near = collections.defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    for n in sorted(nodes):
        stack = [n]
        while stack:
            x = stack.pop()
            for y in near[x]:
                if label[y] > label[n]:
                    label[y] = label[n]
                    stack.append(y)
    return label
