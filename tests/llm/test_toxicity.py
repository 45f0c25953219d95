"""The factorization machine: pairs of terms, held-out accuracy, scores."""

import random
import zlib

import numpy as np
import pytest

from daybook.llm import toxicity
from daybook.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_learns_a_pair_that_neither_term_shows():
    rng = random.Random(5)
    words = [f"n{i}" for i in range(40)]
    rows, labels = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        text = " ".join(rng.sample(words, 12) + ["insult"] * a + ["group"] * b)
        rows.append(toxicity.present(text, toxicity.TermIndex()))
        labels.append(int(a and b))
    m = toxicity.fit(rows, np.array(labels))
    index = toxicity.TermIndex(m.column)
    both, one, other, none = m.logits([toxicity.present(t, index) for t in
                                       ("n1 insult group", "n1 insult n2", "n1 group n2", "n1 n2 n3")])
    assert both > 1 and max(one, other, none) < -1
    linear = m.weights[m.column[toxicity.present("insult group", toxicity.TermIndex())]].sum()
    assert both - (m.bias + linear) > 0.5  # the pair itself counts


def test_learns_a_pair_of_terms_as_frequent_in_both_classes():
    rng = random.Random(6)
    words = [f"n{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(1600):
        a, b = i % 2, i // 2 % 2
        rows.append(toxicity.present(" ".join(rng.sample(words, 12) + ["insult"] * a + ["group"] * b), toxicity.TermIndex()))
        labels.append(a ^ b)
    m = toxicity.fit(rows, np.array(labels))
    index = toxicity.TermIndex(m.column)
    both, one, other, none = m.logits([toxicity.present(t, index) for t in
                                       ("n1 n4 n2 insult group", "n1 n4 n2 insult", "n1 n4 n2 group", "n1 n4 n2 n3")])
    assert min(one, other) > 1 and max(both, none) < -1


@pytest.mark.parametrize("others", [12, 60, 150, 300, 2000])
def test_a_pair_counts_in_long_texts_as_in_short_ones(others):
    rng = random.Random(others)
    words = [f"n{i}" for i in range(max(40, 2 * others))]
    n = 1600 if others < 1000 else 800

    def row(a, b):
        return toxicity.present(" ".join(rng.sample(words, others) + ["insult"] * a + ["group"] * b), toxicity.TermIndex())
    rows = [row(i % 2, i // 2 % 2) for i in range(n)]
    m = toxicity.fit(rows, np.array([(i % 2) ^ (i // 2 % 2) for i in range(n)]))
    held = [(a ^ b, row(a, b)) for a in (0, 1) for b in (0, 1) for _ in range(25)]
    logits = m.logits([c[c >= 0] for c in (m.column[r] for _, r in held)])
    assert sum((x > 0) == bool(y) for x, (y, _) in zip(logits, held)) / len(held) > 0.9


def test_scores_equal_plain_pairwise_sums():
    rng = np.random.default_rng(7)
    column = np.full(toxicity.SPACE, -1, np.int32)
    m = toxicity.Machine(column, -0.3, rng.normal(size=40), rng.normal(size=(40, 8)), full=10)
    rows = [np.sort(rng.choice(40, n, replace=False)) for n in (0, 1, 2, 17, 40)]
    for got, places in zip(m.logits(rows), rows):
        n_plain = sum(int(i) >= 10 for i in places)
        x = {int(i): 1.0 if i < 10 else (1 + n_plain) ** -0.5 for i in places}
        want = -0.3 + sum(m.weights[i] * v for i, v in x.items())
        want += sum(float(m.factors[i] @ m.factors[j]) * x[i] * x[j] for i in x for j in x if i < j)
        assert abs(got - want) < 1e-9


def test_held_out_accuracy_and_inputs(spark):
    got = {r["doc_id"]: r for r in QUERIES["op4_toxicity"](spark, SF).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(got) == set(docs)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    held = [(got[i]["predicted"], y) for i, y in labels.items() if got[i]["held_out"]]
    assert sum(p == y for p, y in held) / len(held) > 0.93
    same = {}
    for i, r in got.items():
        same.setdefault(docs[i], set()).add(r["score"])
    assert all(len(v) == 1 for v in same.values())


def test_one_class_gives_a_constant(make):
    m = toxicity.fit([np.array([1, 2], np.int32)], np.array([0]))
    assert [r["score"] for r in toxicity.score_documents(make([(1, "a b"), (2, None)]), m).collect()] == [0.0, 0.0]
    assert toxicity.fit([], np.array([], int)).bias == -np.inf
