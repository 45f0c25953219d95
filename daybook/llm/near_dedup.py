"""MinHash near-dedup with min-max hashing, confirmed on full shingle sets.

Every permutation of the shingle hashes gives two signature values, its
minimum and its maximum, so ``PERMUTATIONS`` hash evaluations yield twice as
many values.  They are banded by ``ROWS``: the minima in one half of the
bands, the maxima in the other, so the values inside a band come from
different permutations and are independent.  With 48 bands of 6 a pair at the
threshold 0.8 meets in at least one band with probability 1 - 5e-7, a more
similar pair nearly always.

Links are looked for in two steps, neither of which lists the pairs of a group:

1. Star.  In each bucket every document is compared with one pivot only.
   Confirmed links are joined into components.
2. Rest.  Buckets that still hold more than one component are cut into blocks
   of ``BLOCK`` documents, and each pair of blocks is one task's matrix
   product of shingle sets.  It yields a spanning forest of the links found
   between components, never the pairs.

A link needs 100 * intersection >= threshold * union on full sets.  Documents
with the same words are represented by their smallest doc_id throughout.

Defined cases: null text counts as empty; a text of fewer words than a shingle
has one shingle, all its words; a text without words has the empty set and is
linked with nothing; rows with a null doc_id are returned unlinked, with a
null component_id, and kept; rows repeated under one doc_id are one document.
Extra columns pass; a column that clashes with a result column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut, give_back, small_batches, whole_text
from daybook.llm.components import connected

PERMUTATIONS, ROWS, BLOCK = 144, 6, 256
_CACHE = 1 << 19  # words whose hash a task remembers before it starts over


class WordHashes(dict):
    """64-bit hash of a word, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= _CACHE:
            self.clear()
        self[word] = h
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64's constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def tokens(text: str) -> list[bytes]:
    return text.encode().lower().split()  # bytes: A-Z only, and ASCII white space only


def shingle_set(ws: list[bytes], size: int, known: WordHashes) -> np.ndarray:
    """Distinct shingle hashes, sorted."""
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
    k = min(size, len(h))
    rolled = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - k + 1 + j])
    return np.unique(rolled)


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, n, dtype=np.uint64))


def min_max(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, permutations) of minima and of maxima; no set may be empty."""
    flat = np.concatenate(sets)
    starts = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    low = np.empty((len(sets), len(a)), np.uint32)
    high = np.empty_like(low)
    for p in range(len(a)):
        v = ((flat * a[p] + b[p]) >> np.uint64(32)).astype(np.uint32)
        low[:, p] = np.minimum.reduceat(v, starts)
        high[:, p] = np.maximum.reduceat(v, starts)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray, rows: int) -> np.ndarray:
    """(documents, bands) of 64-bit keys; the band's number is part of a key."""
    out = []
    for values in (low, high):
        for at in range(0, values.shape[1], rows):
            key = np.full(len(values), 2 * at + len(out) + 1, np.uint64)
            for j in range(at, at + rows):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + values[:, j].astype(np.uint64))
            out.append(key)
    return np.stack(out, axis=1).astype(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, words_id, n_shingles, bands) of (doc_id, text)."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (a, b) = WordHashes(), coefficients(PERMUTATIONS)
        for batch in batches:
            for part in small_batches(batch):
                ws = [tokens(t.as_py()) for t in part.column("text")]
                ids = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in ws]
                sets = [shingle_set(w, size, known) for w in ws]
                del ws
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                if full:
                    keys = band_keys(*min_max([sets[i] for i in full], a, b), ROWS)
                    for i, k in zip(full, keys):
                        bands[i] = k
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "words_id": pa.array(ids, pa.binary()),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "bands": pa.array(bands, pa.list_(pa.int64()))})
        known.clear()
        give_back()
    return docs.mapInArrow(sign, "doc_id long, words_id binary, n_shingles long, bands array<long>")


def shingles(docs: DataFrame, size: int) -> DataFrame:
    """(id, shingles): the full sets."""
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for part in small_batches(batch):
                sets = [shingle_set(tokens(t.as_py()), size, known) for t in part.column("text")]
                values = np.concatenate(sets).view(np.int64)
                offsets = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "id": part.column("id"), "shingles": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))})
        known.clear()
        give_back()
    return docs.mapInArrow(take, "id long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_sb"))
    both = F.size(F.array_intersect("_sa", "_sb"))
    return (pairs.join(left, "a").join(right, "b")
            .where(100 * both >= percent * (F.size("_sa") + F.size("_sb") - both)).select("a", "b"))


def forest(ids: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], split: int, percent: int) -> list[tuple[int, int]]:
    """Links between different labels that join them, each only if it joins
    something new.  With ``split`` > 0 only rows before it meet rows after it."""
    lens = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), lens)
    _, col, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[col] > 1  # of more than one document
    rank = np.cumsum(times > 1) - 1
    owner, col = owner[shared], rank[col[shared]]
    width = int(rank[-1]) + 1 if len(rank) else 0
    inter = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, width, 8192):  # a slice of the shingles at a time
        here = (col >= at) & (col < at + 8192)
        m = np.zeros((len(sets), min(8192, width - at)), np.float32)
        m[owner[here], col[here] - at] = 1
        inter += m @ m.T
    union = lens[:, None] + lens[None, :] - inter
    near = np.triu((100 * inter >= percent * union) & (labels[:, None] != labels[None, :]), 1)
    if split:
        near[:split, :split] = False
        near[split:, split:] = False
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x
    out = []
    for i, j in zip(*np.nonzero(near)):
        x, y = find(int(labels[i])), find(int(labels[j]))
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((int(ids[i]), int(ids[j])))
    return out


def rest_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components inside buckets of (key, id, comp)."""
    by_bucket = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.sum(F.xxhash64("id") % (1 << 40)).alias("who"), F.min("id").alias("first")).where("low < high")
    # of buckets with the same members, one
    by_bucket = by_bucket.groupBy("n", "who", "first").agg(F.min("key").alias("key"))
    rows = members.join(by_bucket.select("key", "n"), "key")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("key", "id", "comp", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    schema = "a long, b long"

    def link(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        mine, lo = t.column("mine").to_numpy(), t.column("lo")[0].as_py()
        order = np.argsort(mine != lo, kind="stable")
        split = int((mine == lo).sum()) % len(mine)
        # one label on all sides: nothing to join
        labels = t.column("comp").to_numpy()[order]
        found: list = []
        if labels.min() != labels.max():
            values = t.column("shingles").chunk(0)
            flat, at = values.values.to_numpy().view(np.uint64), values.offsets.to_numpy()
            found = forest(t.column("id").to_numpy()[order], labels, [flat[at[i]:at[i + 1]] for i in order], split, percent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return rows.join(sets, "id").groupBy("key", "lo", "hi").applyInArrow(link, schema).distinct()


def near_components(docs: DataFrame, size: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, words_id, n_shingles, component_id) of (doc_id, text)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    signed = cut(signatures(base, size))
    real = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    reps = real.groupBy("words_id").agg(F.min(F.struct("doc_id", "bands")).alias("r")).select(
        "words_id", F.col("r.doc_id").alias("id"), F.col("r.bands").alias("bands"))
    rows = reps.select("id", F.explode("bands").alias("key"))
    pivot = F.min(F.struct(F.xxhash64("key", "id").alias("h"), F.col("id").alias("id")))
    buckets = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), pivot.alias("p")).where("n > 1")
    members = cut(rows.join(buckets.select("key", F.col("p.id").alias("pivot")), "key"))
    pairs = (members.where("id <> pivot")
             .select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct())
    wanted = members.select("id").distinct()
    sets = cut(shingles(base.withColumnRenamed("doc_id", "id").join(wanted, "id", "left_semi")
                        .groupBy("id").agg(F.min("text").alias("text")), size))
    star = cut(confirmed(pairs, sets, percent))
    comp = connected(star)
    labelled = members.join(comp, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp"))
    more = rest_links(labelled, sets, percent)
    comp = connected(cut(star.unionByName(more)))
    owner = reps.select("words_id", "id").join(comp, "id", "left").select(
        "words_id", F.coalesce("comp", "id").alias("_comp"))
    return (signed.select("doc_id", "words_id", "n_shingles").join(owner, "words_id", "left")
            .select("doc_id", "words_id", "n_shingles",
                    F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("_comp"))
                    .otherwise(F.col("doc_id")).alias("component_id")))


def verdicts(docs: DataFrame, size: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, a row per row of ``docs``."""
    kept: Column = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return near_components(docs, size, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_copies(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the one of smallest doc_id."""
    gone = verdicts(docs, size, percent).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
