"""Brute-force versions for small fixtures."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n):
    w = words(lower(text))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def jaccard_classes(rows, n, num, den):
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1:]:
            if a and b and den * len(a & b) >= num * len(a | b):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    size = {}
    for i, a in sets:
        size[i] = max(size.get(i, 0), len(a))
    return {i: (size[i], find(i)) for i in size}
