"""Plain, slow versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def substring_dedup(rows, window=20):
    """{id: (n_words, n_removed, kept text)} of rows (id, text) with distinct ids."""
    first, docs = {}, sorted(rows)
    for i, text in docs:
        w = words(text)
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s:s + window]), (i, s))
    out = {}
    for i, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (i, s):
                gone[s:s + window] = [True] * window
        out[i] = (len(w), sum(gone), " ".join(a for a, g in zip(w, gone) if not g))
    return out


def simhash(text, shingle=3):
    w = words(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)]
    if w and not parts:
        parts = [" ".join(w)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(n, linked):
    """Smallest index reachable from each of n nodes, given linked(i, j)."""
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def cosine_links(vectors, threshold=0.9):
    """(links of each, component of each) of rows (id, vector or None), ids ascending."""
    def ok(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok(v) else None for _, v in vectors]
    link = lambda i, j: (unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j])
                         and unit[i] @ unit[j] >= threshold)
    n = len(vectors)
    root = groups(n, link)
    return {vectors[i][0]: (sum(link(i, j) for j in range(n) if j != i), vectors[root[i]][0])
            for i in range(n)}


def turns(rows):
    """{conv: (n_turns, digest, loss chars, loss digest)} of rows (conv, turn, role, text)."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, said in by.items():
        said.sort()
        loss = "".join(t for _, r, t in said if r == "assistant")
        every = "".join(f"{r}\n{t}\n" for _, r, t in said)
        out[conv] = (len(said), hashlib.sha256(every.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out
