"""Line dedup against plain Python, for both rules."""

import numpy as np
import pytest

from daybook.llm import line_dedup


def _expected(rows, min_docs, keep):
    keys = {i: line_dedup.line_keys(t) for i, t in rows}
    at = {}
    for i, ks in keys.items():
        for n, k in enumerate(ks):
            if k:
                at.setdefault(k, []).append((i, n))
    many = {k for k, v in at.items() if len({i for i, _ in v}) >= min_docs}
    first = {k: min(at[k]) for k in many} if keep == "first" else {}
    return {i: "\n".join(x for n, (x, k) in enumerate(zip(t.split("\n"), keys[i]))
                         if k not in many or first.get(k) == (i, n)) for i, t in rows}


@pytest.mark.parametrize("keep", ["none", "first"])
def test_equals_plain_counting(make, texts, keep):
    rows = [(i, f"Shared line {i % 3}\nown {i}\n\n  SHARED line {i % 3}\t\n{texts[i]}") for i in sorted(texts)][:80]
    rows += [(1000 + i, f"seldom {i // 4}\nx") for i in range(40)]
    want = _expected(rows, 10, keep)
    got = line_dedup.drop_repeated_lines(make(rows), min_docs=10, keep=keep).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    assert all(r["n_lines"] - r["n_dropped"] == (0 if r["n_dropped"] == r["n_lines"] else want[r["doc_id"]].count("\n") + 1) for r in got)


def test_filters_never_miss_a_second_document():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)
    parts = [line_dedup.Filters(3) for _ in range(4)]
    for k in range(4):  # key i is in parts i % 4 and, for the first thousand, i // 4 % 4
        parts[k].add(keys[[i for i in range(5000) if i % 4 == k]])
        parts[k].add(keys[[i for i in range(1000) if i // 4 % 4 == k]])
    merged = line_dedup.Filters(3)
    for p in parts:
        for b in p.batches():
            for s, once, twice in zip(*(b.column(c).to_pylist() for c in ("seg", "once", "twice"))):
                merged.merge(s, once, twice)
    twice = {s: v.tobytes() for s, v in merged.twice.items()}
    hit = line_dedup.has_twice(twice, 3, keys)
    assert hit[:1000].all() and hit[1000:].mean() < 0.05


def test_saturated_filters_cost_rows_but_change_nothing(make, monkeypatch):
    rows = [(i, "\n".join([f"line {i}", f"common {i % 2}", f"pair {i // 2}"])) for i in range(60)]
    monkeypatch.setattr(line_dedup, "SEGMENT_BITS", 64)
    monkeypatch.setattr(line_dedup, "MAX_BITS", 64)
    got = line_dedup.drop_repeated_lines(make(rows)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == _expected(rows, 10, "none")
