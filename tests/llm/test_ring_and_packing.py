"""Sharding and packing: laws, and optimal bounds against exhaustive search."""

import itertools
import random
import zlib

from daybook.llm import packing, sharding


def test_rows_law_and_slots(docs, texts):
    rows = sharding.shard(docs).collect()
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        by.setdefault(r["shard"], []).append(r["slot"])
    assert set(by) == set(range(16)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_placement_does_not_depend_on_the_layout(docs):
    a = sharding.shard(docs.repartition(7))
    assert sharding.shard(docs.repartition(3)).exceptAll(a).count() == 0


def test_plan_places_each_rank_once_and_moves_little():
    rng = random.Random(1)
    counts = {rng.randrange(sharding.CELLS): rng.randrange(1, 40) for _ in range(6000)}

    def owners(shards):
        out = {}
        for cell, lo, hi, s, _ in sharding.plan(counts, shards):
            for k in range(lo, hi):
                assert (cell, k) not in out
                out[cell, k] = s
        assert len(out) == sum(counts.values())
        return out
    a, b = owners(16), owners(17)
    moved = sum(a[k] != b[k] for k in a) / len(a)
    assert moved < 0.25  # 1 in 17 has to move


def test_bounds_are_optimal():
    rng = random.Random(2)
    for _ in range(150):
        h = {rng.randint(1, 40): rng.randint(1, 9) for _ in range(rng.randint(1, 9))}
        lengths = sorted(h)
        for k in (1, 2, 3, 5):
            least = min(packing.padding(h, [*c, lengths[-1]]) for r in range(k) for c in itertools.combinations(lengths[:-1], r))
            bounds = packing.best_bounds(h, k)
            assert len(bounds) <= k and bounds[-1] == lengths[-1] and packing.padding(h, bounds) == least
    assert packing.best_bounds({}, 4) == []


def test_batches_hold_the_budget(docs, texts):
    rows = packing.pack(docs, buckets=4, budget=3000).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(t.encode().split()) + 1 for i, t in texts.items()}
    lengths = {r["bucket"]: r["bucket_len"] for r in rows}
    h = {}
    for r in rows:
        h[r["n_tokens"]] = h.get(r["n_tokens"], 0) + 1
    assert sorted(lengths.values()) == packing.best_bounds(h, 4)
    assert sum(r["padding"] for r in rows) == packing.padding(h, sorted(lengths.values()))
    batches = {}
    for r in rows:
        assert 0 <= r["padding"] == r["bucket_len"] - r["n_tokens"]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for (bucket, _), members in batches.items():
        assert len(members) == 1 or len(members) * lengths[bucket] <= 3000
        assert sorted(m["place"] for m in members) == list(range(len(members)))
    for bucket in lengths:  # no gap, and every batch but the last is full
        own = sorted(b for k, b in batches if k == bucket)
        assert own == list(range(len(own)))


def test_lengths_can_be_a_column(make, spark):
    from daybook.llm import packing
    rows = [(i, "x" * 50 if i % 2 else "a b c", None if i == 3 else 100 * (i % 5)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    got = {r["doc_id"]: r for r in packing.pack(docs, buckets=4, budget=800, length="n").collect()}
    assert {i: r["n_tokens"] for i, r in got.items()} == {i: max(1, n or 1) for i, _, n in rows}
    used = {}
    for r in got.values():
        used[r["bucket"], r["batch"]] = used.get((r["bucket"], r["batch"]), 0) + r["bucket_len"]
    assert max(used.values()) <= 800
