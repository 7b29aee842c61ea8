"""Operator 5 against all pairs."""

import math
import random

import numpy as np
import pytest

from duotower.llm.components import components
from duotower.llm.decontaminate import words_of
from duotower.llm.near_join import common_shingles, least_agreement, near_join, surviving_pairs


def shingles(text):
    w = words_of(text)
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    links, label = [0] * n, list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 5 * inter >= 4 * (len(sets[i]) + len(sets[j]) - inter):
                links[i] += 1
                links[j] += 1
                label[find(i)] = find(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        c = find(k)
        least[c] = min([least.get(c, (True, 0)), (d is None, d or 0)])
    return [(d, None if least[find(k)][0] else least[find(k)][1], links[k]) for k, (d, _) in enumerate(rows)]


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 8, 30, 80, 200]))]
        for _ in range(rng.choice([1, 1, 1, 2, 4])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append(" ".join(own))
    # one large group of near copies around one text, and one of exact copies
    base = [rng.choice(vocabulary) for _ in range(150)]
    for _ in range(90):
        own = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            own[rng.randrange(150)] = rng.choice(vocabulary)
        rows.append(" ".join(own))
    rows += [rows[0].upper() + "!"] * 30
    return [(1000 - k, t) for k, t in enumerate(rows)] + [(None, rows[5]), (2000, None), (2001, ""), (2002, "?!"), (None, None)]


@pytest.mark.parametrize("chunk", [256, 16])
def test_near_join(spark, make_docs, chunk):
    rows = corpus()
    docs = make_docs(rows).withColumnRenamed("lang", "rid").withColumnRenamed("source", "key")
    got = sorted([tuple(r) for r in near_join(docs, chunk=chunk).collect()], key=str)
    assert got == sorted(brute(rows), key=str)


def test_empty_table(spark, make_docs):
    assert near_join(make_docs([(1, "x")]).limit(0)).count() == 0
    assert [tuple(r) for r in near_join(make_docs([(7, "alone here")])).collect()] == [(7, 7, 0)]


def test_pruning_keeps_what_can_reach_the_threshold():
    need = least_agreement(1e-9)
    for k, a in enumerate(need):
        m = 16 * (k + 1)
        below = sum(math.comb(m + 1, x) * 0.8 ** x * 0.2 ** (m + 1 - x) for x in range(a))
        assert below < 1e-9 and 0 <= a < m
    rng = np.random.default_rng(1)
    left = rng.integers(0, 1 << 32, (20, 128), dtype=np.uint32)
    right = np.where(rng.random((20, 128)) < 0.8, left, 0).astype(np.uint32)
    i, j = surviving_pairs(left, right, False, 1e-9)
    assert list(zip(i.tolist(), j.tolist())) == [(k, k) for k in range(20)]


def test_common_shingles_both_ways():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 9000, 3000).astype(np.uint64)) for _ in range(30)]
    i, j = (x.ravel() for x in np.mgrid[0:30, 0:30])
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]
    assert common_shingles(sets, sets, i, j).tolist() == want
    assert common_shingles(sets, sets, i[:5], j[:5]).tolist() == want[:5]


def test_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(100, 160)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(5, k) for k in range(6, 60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in edges)}
