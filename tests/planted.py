"""Small inputs with a known answer."""

import random

import numpy as np


def topic_corpus(k=5, words=40, docs=60, own=0.8, length=40, seed=7):
    """``(id, tokens, label)`` with disjoint word sets per topic."""
    rng = random.Random(seed)
    sets = [[f"{chr(97 + t)}{chr(97 + i // 26)}{chr(97 + i % 26)}q" for i in range(words)] for t in range(k)]
    rows = []
    for t in range(k):
        for _ in range(docs):
            tokens = [
                rng.choice(sets[t]) if rng.random() < own else rng.choice(rng.choice(sets)) for _ in range(length)
            ]
            rows.append((len(rows), tokens, t))
    return rows


def vector_groups(groups=4, points=30, dims=16, far=15, seed=3):
    """Tight groups plus far points, as ``(id, embedding, label)``; far points are -1."""
    rng = np.random.RandomState(seed)
    centres = rng.normal(0, 10, (groups, dims))
    rows = []
    for g, c in enumerate(centres):
        for p in c + rng.normal(0, 0.3, (points, dims)):
            rows.append((len(rows), p.tolist(), g))
    for p in rng.normal(0, 60, (far, dims)):
        rows.append((len(rows), p.tolist(), -1))
    return rows


def adjusted_rand(a, b):
    """Adjusted Rand index by counting pairs."""
    n = len(a)
    same = both_a = both_b = 0
    for i in range(n):
        for j in range(i):
            x, y = a[i] == a[j], b[i] == b[j]
            both_a += x
            both_b += y
            same += x and y
    expected = both_a * both_b / (n * (n - 1) / 2)
    span = (both_a + both_b) / 2 - expected
    return 1.0 if span == 0 else (same - expected) / span
