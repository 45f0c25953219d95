"""Runs against trying every period, and the wavelet tree against sorting."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from daybook.llm import periodic_runs as pr
from daybook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(words, least=6, times=4):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - a + q
            if length >= max(least, times * q) and not any(
                    all(words[a + x] == words[a + x + p] for x in range(length - p)) for p in range(1, q)):
                out.append((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def documents(rng, n):
    out = []
    for _ in range(n):
        v = rng.choice([1, 2, 2, 3, 5, 50])
        words = [b"%d" % rng.randrange(v) for _ in range(rng.randrange(140))]
        for _ in range(rng.randrange(4)):
            unit = [b"%d" % rng.randrange(v) for _ in range(rng.randrange(1, 25))]
            run = (unit * 10)[:int(len(unit) * rng.uniform(2.5, 7))]
            at = rng.randrange(len(words) + 1)
            words[at:at + rng.choice([0, len(run)])] = run
        out.append(words)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_all_runs_and_no_others(seed):
    docs = documents(random.Random(seed), 200)
    assert pr.runs_of_all(docs) == [brute(d) for d in docs]


def test_long_and_nested_runs():
    word = [b"a", b"b"]
    fibonacci = [[b"a"], [b"a", b"b"]]
    while len(fibonacci[-1]) < 900:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    unit = [b"x%d" % i for i in range(300)]
    docs = [[b"a"] * 5000, word * 1000, fibonacci[-1], unit * 4, unit * 4 + unit[:-1], unit * 3, (word * 6 + [b"c"]) * 5, [], [b"a"]]
    assert pr.runs_of_all(docs[:2]) == [[(0, 5000, 1)], [(0, 2000, 2)]]
    assert pr.runs_of_all(docs) == [[(0, 5000, 1)], [(0, 2000, 2)]] + [brute(d) for d in docs[2:]]


def test_range_successors():
    rng = np.random.default_rng(8)
    values = rng.permutation(700)[:500]
    tree = pr.WaveletTree(values)
    lo = rng.integers(0, 500, 3000)
    hi = np.minimum(lo + rng.integers(0, 60, 3000), 500)
    x = rng.integers(0, 1100, 3000)
    want = [min((v for v in values[a:b].tolist() if v >= k), default=-1) for a, b, k in zip(lo, hi, x)]
    assert tree.successor(lo, hi, x).tolist() == want


def test_a_progression_gives_its_one_candidate():
    # the block aaaa is found at several places of the next period
    unit = [b"a"] * 9 + [b"b"]
    assert pr.runs_of_all([unit * 5]) == [brute(unit * 5)] and (0, 50, 10) in brute(unit * 5)


def test_the_query_equals_trying_every_period(spark, texts):
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    some = 0
    for doc_id, text in texts.items():
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 800:
            continue
        runs = brute(words)
        some += bool(runs)
        r = got[doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert r["collapsed_sha256"] == hashlib.sha256(kept).hexdigest()
        assert r["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
    assert some > 5


def test_whole_results_of_the_operator(make):
    out = {r["doc_id"]: r for r in pr.detect(make([(1, "a b a b a b a b c"), (2, None), (3, "x " * 7)])).collect()}
    assert out[1]["collapsed"] == "a b c" and [tuple(x) for x in out[1]["runs"]] == [(0, 8, 2)] and out[1]["text"]
    assert out[2]["collapsed"] == "" and out[2]["runs"] == [] and out[3]["collapsed"] == "x" and out[3]["n_words"] == 7
    with pytest.raises(ValueError):
        pr.find_runs(*pr.codes_of([[b"a"]]), times=2)
