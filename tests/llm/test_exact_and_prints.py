"""Exact dedup and fingerprints against plain Python."""

import hashlib
import re
import statistics

from pyspark.sql import functions as F

from daybook.llm import exact_dedup, fingerprints


def _norm(t):
    return re.sub(r"[\x20\x09-\x0d]", "", t or "")


def test_exact_dedup_equals_grouping(docs, texts):
    groups = {}
    for i, t in texts.items():
        groups.setdefault(_norm(t), []).append(i)
    for r in exact_dedup.exact_dedup(docs).collect():
        g = groups[_norm(texts[r["doc_id"]])]
        keep = min(g, key=lambda i: (-len(texts[i]), i))
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(g), keep == r["doc_id"])
        assert r["text_sha256"] == hashlib.sha256(_norm(texts[r["doc_id"]]).encode()).hexdigest()


def test_clashing_chunk_identifiers_are_told_apart(docs):
    def weak(c):  # many chunks share an identifier
        return F.unhex(F.lpad(F.hex(F.char_length(c) % 7), 2, "0"))
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    right = exact_dedup.exact_dedup(docs).select(cols)
    got = exact_dedup.exact_dedup(docs, weak).select(cols)
    assert got.exceptAll(right).count() == 0 and right.exceptAll(got).count() == 0


def test_chunks_join_to_the_text(make):
    t = "x" * 5000 + ". " + "ab. " * 400 + "end"
    got = make([(1, t)]).select(exact_dedup.chunks(exact_dedup.normalised(F.col("text"))).alias("c")).first()["c"]
    assert "".join(got) == _norm(t) and max(map(len, got)) <= exact_dedup.MAX_CHUNK


def test_no_python_in_native_plans(docs):
    for df in (exact_dedup.exact_dedup(docs), fingerprints.edited_and_next(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def _shingles(t):
    w = t.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_fingerprints_of_edited_and_next(docs, texts):
    got = {r["doc_id"]: r for r in fingerprints.edited_and_next(docs).collect()}
    order = sorted(texts, reverse=True)
    wrong, by_text = [], {}
    for at, i in enumerate(order):
        a, b = texts[i], texts[order[(at + 1) % len(order)]]
        k = len(a) // 3
        edited = a[:len(a) - k] + b[:k]
        r = got[i]
        assert r["n_chars"] == len(a) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        by_text.setdefault(a, set()).add(r["fingerprint"])
        for name, other in (("near_edited", edited), ("near_next", b)):
            x, y = _shingles(a), _shingles(other)
            if min(len(x), len(y)) >= 60:  # of a few shingles an estimate is coarse
                wrong.append(r[name] - len(x & y) / len(x | y))
    assert all(len(v) == 1 for v in by_text.values())
    assert abs(statistics.mean(wrong)) < 0.02 and statistics.pstdev(wrong) < 0.06


def test_next_row_across_ranges(docs, texts):
    base = docs.withColumn("sig", F.array(F.lit(0).cast("long")))
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(base, rows_per_range=7).collect()}
    order = sorted(texts, reverse=True)
    assert got == {i: texts[order[(k + 1) % len(order)]] for k, i in enumerate(order)}


def test_densified_bins_copy_a_non_empty_bin(make):
    few = make([(1, "one two three four five six seven")]).select(fingerprints.signature(F.col("text")).alias("s")).first()["s"]
    assert len(few) == fingerprints.BINS * fingerprints.BITS // 64
    nibbles = {(v >> (4 * k)) & 15 for v in few for k in range(16)}
    assert len(nibbles) <= 3  # three shingles fill all bins
