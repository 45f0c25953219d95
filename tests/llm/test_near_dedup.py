"""Near-dedup components against all pairs, and its parts."""

import random

import numpy as np
import pytest

from daybook.llm import components, near_dedup


def _truth(rows, size=4, percent=80):
    sets, same = {}, {}
    for i, t in sorted(rows):
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_documents_equal_all_pairs(docs, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.verdicts(docs).collect()}
    assert got == _truth(texts.items())


@pytest.fixture(scope="module")
def hot_group():
    rng = random.Random(7)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(420):  # copies of one text, from slightly to strongly changed
        words = list(base)
        for _ in range(rng.randrange(0, 14)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9000)}"
        rows.append((i, " ".join(words)))
    return rows + [(1000, "a b c"), (1001, "A  b c"), (1002, "a b c d"), (1003, ""), (1004, "  ")]


def test_hot_group_equals_all_pairs(make, hot_group, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 32)  # many blocks
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.verdicts(make(hot_group)).collect()}
    want = _truth(hot_group)
    assert got == want and len({c for _, c in want.values()}) > 20


def test_min_max_estimates_similarity():
    a, b = near_dedup.coefficients(near_dedup.PERMUTATIONS)
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    low, high = near_dedup.min_max([x[:900], x[100:]], a, b)
    estimate = np.concatenate([low[0] == low[1], high[0] == high[1]]).mean()
    assert abs(estimate - 0.8) < 0.08


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 101 + i) for i in range(5)] + [(300, 300)]
    random.Random(1).shuffle(chain)
    got = {r["id"]: r["comp"] for r in components.connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 106)}}


def test_drop_near_copies_keeps_one_of_each(make, hot_group):
    left = {r["doc_id"] for r in near_dedup.drop_near_copies(make(hot_group), size=5).collect()}
    assert left == {i for i, (_, c) in _truth(hot_group, 5).items() if i == c}
