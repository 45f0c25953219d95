"""Buckets, gains, weights, scores and ranks against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from daybook.llm import importance_resampling as ir
from daybook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = ["", "  ", "A", "é Ñ A1", "\x00a\x7fb{c}[d]", "a" * 100 + " " + "a" * 100 + " " + "a" * 99 + "b", "İ ß Z", "x" * 31 + " " + "x" * 32]


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def expected(docs, target, percent=25, least=20, seed=7):
    """{row number: (n_features, weight, score, rank)} of (doc_id, text) rows."""
    k = 10000
    count = lambda ts: collections.Counter(zlib.crc32(f.encode()) % k for t in ts for f in features(t)[1])
    s, t = count(x for _, x in docs), count(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + k) / ((s[b] + 1) * (all_t + k)))) for b in range(k)]
    rows = []
    for i, (doc_id, text) in enumerate(docs):
        words, fs = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % k] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([i, doc_id, len(words), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[2] >= least), key=lambda r: (-r[5], -1 if r[1] is None else r[1]))
    rank = {r[0]: n for n, r in enumerate(able[:percent * len(able) // 100], 1)}
    return {r[0]: (r[3], r[4], r[5], rank.get(r[0])) for r in rows}


def test_hashes_equal_the_libraries(texts):
    data = "\n".join([t or "" for t in list(texts.values())[:20]] + ODD).encode()
    rng = np.random.default_rng(3)
    starts = rng.integers(0, len(data) - 80, 4000)
    lengths = rng.integers(0, 80, 4000)
    keys, crcs = ir.xxhash64(data, starts, lengths), ir.crc32s(data, starts, lengths)
    for a, n, k, c in zip(starts.tolist(), lengths.tolist(), keys.tolist(), crcs.tolist()):
        assert k == ir.xxh64_intdigest(data[a:a + n]) and c == zlib.crc32(data[a:a + n])


@pytest.mark.parametrize("hash_of", [ir.xxhash64, lambda data, starts, lengths: (lengths % 3).astype(np.uint64)])
def test_the_table_tells_n_grams_apart_by_their_bytes(texts, hash_of):
    batch = [t or "" for t in list(texts.values())[:6]] + ODD
    s = ir.Slices([t.encode() for t in batch])
    grams = ir.Grams(s, ir.BUCKETS, hash_of)
    want = collections.Counter(f for t in batch for f in features(t)[1])
    assert len(grams.used) == len(want) and sorted(grams.count[grams.used]) == sorted(want.values())
    by_bucket = collections.Counter()
    for f, n in want.items():
        by_bucket[zlib.crc32(f.encode()) % ir.BUCKETS] += n
    assert {b: n for b, n in enumerate(grams.by_bucket(ir.BUCKETS).tolist()) if n} == by_bucket
    assert [len(features(t)[0]) for t in batch] == s.words.tolist()


def test_the_query_equals_plain_python(spark, texts):
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = sorted(texts.items())
    want = expected(docs, target)
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_importance_resampling"](spark, SF).collect()}
    assert got == {docs[i][0]: x for i, x in want.items()}
    drawn = [x[3] for x in got.values() if x[3] is not None]
    assert sorted(drawn) == list(range(1, len(drawn) + 1)) and len(drawn) > 20


def test_ties_repeated_rows_and_null_ids(make, spark):
    rng = random.Random(2)
    text = lambda: " ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(25))
    rows = [(i % 7, t) for i, t in enumerate([text()] * 30)] + [(None, text())] * 5 + [(i, text()) for i in range(100, 140)] + [(9, None), (9, "")]
    want = collections.Counter((rows[i][0] or -1, *x) for i, x in expected(rows, ["aa bb cc"], percent=60).items())
    out = ir.resample(make(rows), spark.createDataFrame([("aa bb cc",)], "text string"), percent=60)
    assert collections.Counter((r["doc_id"] or -1, r["n_features"], r["weight"], r["score"], r["rank"]) for r in out.collect()) == want
    kept = ir.drawn(make(rows), out)
    assert kept.columns == ["doc_id", "text"] and kept.count() > 0


def test_an_empty_target_and_an_empty_table(make, spark):
    none = spark.createDataFrame([], "text string")
    rows = [(i, "the common words " * 10 + f"own{i}") for i in range(8)]
    want = expected(rows, [], percent=50)
    got = ir.resample(make(rows), none, percent=50).collect()
    assert {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in got} == want
    assert ir.resample(make([]), none).collect() == []
