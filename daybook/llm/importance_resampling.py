"""Importance resampling of documents towards the distribution of a target.

Words are runs of digits, a-z (A-Z in lower case) and characters beyond ASCII;
features are all runs of one and of two consecutive words, joined by one space,
repeats counted.  A feature's bucket is the crc32 of its bytes modulo
``BUCKETS``.  With S features in all documents, s of them in a bucket, and T
and t for the target's texts, the bucket's gain is

    floor(1000 * ln((t + 1) * (S + BUCKETS) / ((s + 1) * (T + BUCKETS))))

and a document's weight the floored mean of the gains of its features.  Adding
Gumbel noise from a hash of doc_id and taking the highest scores draws without
replacement in proportion to exp(weight / 1000).

The texts are read twice, once to count buckets and once to weigh.  In each
pass a task interns the n-grams of a batch in an open-addressed table
(:class:`Grams`): xxhash64 of the bytes gives the first slot, linear probing the
next ones, and an n-gram takes a slot only where the bytes of its first
occurrence are the same, so a collision of hashes changes nothing.  A slot holds
the bucket (one crc32 for each distinct n-gram) and the count; occurrences are
slot numbers, and gather the gains of their slots.

A task sends at most ``BUCKETS`` counts, and the gains that go to every task are
``BUCKETS`` numbers.  Ranks are global without one task sorting all: scores are
whole numbers of a bounded range (about 60,000 values), so the counts by score
are a bounded table; its running sum gives each score's first rank, and rows of
one score are numbered by doc_id.

Defined cases: null text counts as empty; a text without words has no features
and weight 0; a null doc_id has the noise of the empty id and comes first of
ties; rows repeated are scored and drawn each; an empty table gives an empty
result, and an empty target weights all buckets by their rarity alone.  Extra
columns pass ``resample``, except the text, which ``drawn`` joins again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from daybook.llm.common import cut
from daybook.llm.near_dedup import small_batches

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10000, 20, 25, 7


# ---- words and n-grams as slices of one buffer

def _tables() -> tuple[np.ndarray, np.ndarray]:
    b = np.arange(256)
    upper = (b >= ord("A")) & (b <= ord("Z"))
    lower = np.where(upper, b + 32, b).astype(np.uint8)
    word = (lower >= ord("a")) & (lower <= ord("z")) | (b >= ord("0")) & (b <= ord("9")) | (b >= 128)
    return lower, word


LOWER, IN_WORD = _tables()


class Slices:
    """The n-grams of some texts as slices of ``data``, in which the words of
    all texts follow one another, each ended by a space."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        inside = IN_WORD[raw]
        before = np.r_[False, inside[:-1]]
        kept = np.flatnonzero(inside | before)  # words, and one byte after each
        self.data = np.where(inside, LOWER[raw], 32)[kept].astype(np.uint8)
        edge = ~inside[kept]
        ends = np.flatnonzero(edge)
        starts = np.r_[0, ends[:-1] + 1][:len(ends)]
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        doc = np.searchsorted(text_ends, kept[ends], "right")
        self.words = np.bincount(doc, minlength=len(texts))  # of each text
        pair = np.flatnonzero(doc[1:] == doc[:-1])
        self.starts = np.r_[starts, starts[pair]]
        self.ends = np.r_[ends, ends[pair + 1]]
        self.doc = np.r_[doc, doc[pair]]


# ---- hashes of slices, all at once

# fixed values: the primes of xxhash64
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_LONG = 32  # longer slices are hashed one by one


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def eight_bytes(data: bytes) -> np.ndarray:
    """The eight bytes from every position of ``data`` as one number, zeros beyond the end."""
    return np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))


def xxhash64(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """xxhash64 of every slice of ``data``."""
    eight, h = eight_bytes(data), lengths.astype(np.uint64) + P5
    at, left = starts.copy(), lengths.copy()
    i = np.flatnonzero((left >= 8) & (lengths < _LONG))
    while len(i):
        h[i] = _turned(h[i] ^ _turned(eight[at[i]] * P2, 31) * P1, 27) * P1 + P4
        at[i] += 8
        left[i] -= 8
        i = i[left[i] >= 8]
    i = np.flatnonzero((left >= 4) & (lengths < _LONG))
    h[i] = _turned(h[i] ^ (eight[at[i]] & np.uint64(0xFFFFFFFF)) * P1, 23) * P2 + P3
    at[i] += 4
    left[i] -= 4
    i = np.flatnonzero((left > 0) & (lengths < _LONG))
    while len(i):
        h[i] = _turned(h[i] ^ (eight[at[i]] & np.uint64(0xFF)) * P5, 11) * P1
        at[i] += 1
        left[i] -= 1
        i = i[left[i] > 0]
    h = (h ^ h >> np.uint64(33)) * P2
    h = (h ^ h >> np.uint64(29)) * P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(lengths >= _LONG):
        h[i] = xxh64_intdigest(data[starts[i]:starts[i] + lengths[i]])
    return h


def _crc_table() -> np.ndarray:
    """The eight steps that a byte takes through the reversed polynomial."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, x >> 1 ^ np.uint32(0xEDB88320), x >> 1).astype(np.uint32)
    return x


CRC_OF_BYTE = _crc_table()


def crc32s(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of every slice of ``data``, a byte of all of them at a time."""
    raw = np.frombuffer(data, np.uint8)
    order = np.argsort(-np.minimum(lengths, _LONG), kind="stable")
    size, at = lengths[order], starts[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    more = np.searchsorted(-size, -np.arange(_LONG), "left")  # slices of more than j bytes
    for j in range(_LONG):
        m = more[j]
        if m:
            crc[:m] = CRC_OF_BYTE[crc[:m] & np.uint32(0xFF) ^ raw[at[:m] + j]] ^ crc[:m] >> np.uint32(8)
    out = np.empty(len(order), np.int64)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > _LONG):
        out[i] = crc32(data[starts[i]:starts[i] + lengths[i]])
    return out


# ---- the open-addressed table

class Grams:
    """Slots of the n-grams of one batch.

    ``slot`` is the slot of every occurrence; ``used`` the slots taken, and at
    those ``bucket`` and ``count``.
    """

    def __init__(self, s: Slices, buckets: int = BUCKETS, hash_of=xxhash64):
        data, n = s.data.tobytes(), len(s.starts)
        length = s.ends - s.starts
        keys = hash_of(data, s.starts, length)
        size = 1 << max(1, 2 * n - 1).bit_length()  # at most half full
        eight = eight_bytes(data)
        owner = np.full(size, -1, np.int64)  # the occurrence that took a slot
        self.slot = (keys & np.uint64(size - 1)).astype(np.int64)
        todo = np.arange(n)
        while len(todo):
            at = self.slot[todo]
            free = owner[at] < 0
            owner[at[free]] = todo[free]
            other = owner[at]
            same = (keys[other] == keys[todo]) & (length[other] == length[todo])
            look = np.flatnonzero(same & (other != todo))
            same[look] = _same_bytes(eight, s.starts[todo[look]], s.starts[other[look]], length[todo[look]])
            todo = todo[~same]
            self.slot[todo] = (self.slot[todo] + 1) & (size - 1)
        self.used = np.flatnonzero(owner >= 0)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        first = owner[self.used]
        self.bucket[self.used] = crc32s(data, s.starts[first], length[first]) % buckets

    def by_bucket(self, buckets: int) -> np.ndarray:
        """Occurrences in each bucket."""
        return np.bincount(self.bucket[self.used], self.count[self.used], buckets).astype(np.int64)


def _same_bytes(eight: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the slices of equal length at a and b are equal, eight bytes at a time."""
    same, left = np.ones(len(a), bool), np.arange(len(a))
    at = 0
    while len(left):
        rest = np.minimum(length[left] - at, 8).astype(np.uint64)
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * rest)
        equal = (eight[a[left] + at] ^ eight[b[left] + at]) & mask == 0
        same[left[~equal]] = False
        at += 8
        left = left[equal & (length[left] > at)]
    return same


# ---- counts, gains, weights

def _texts(part: pa.RecordBatch) -> list[bytes]:
    return [(t.as_py() or "").encode() for t in part.column("text")]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in small_batches(batch):
                total += Grams(Slices(_texts(part)), buckets).by_bucket(buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    sums = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():  # one row a bucket
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    k, all_s, all_t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_s + k) / ((s + 1) * (all_t + k))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """``docs`` without the text, with n_words, n_features and weight."""
    base = docs.drop("n_words", "n_features", "weight")
    names = [c for c in base.columns if c != "text"]
    schema = T.StructType([*[base.schema[c] for c in names], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch):
                s = Slices(_texts(part))
                grams = Grams(s, len(gains))
                of_slot = gains[grams.bucket]
                features = np.bincount(s.doc, minlength=part.num_rows)
                total = np.bincount(s.doc, of_slot[grams.slot], part.num_rows).astype(np.int64)  # whole numbers far under 2^53
                new = {"n_words": s.words, "n_features": features, "weight": total // np.maximum(features, 1)}
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in names} | {c: pa.array(x, pa.int64()) for c, x in new.items()})
    return base.mapInArrow(rate, schema)


# ---- scores and ranks

def noise(seed: int = SEED):
    """floor(1000 * Gumbel noise) of doc_id: h in 32 bits, -ln(-ln((h + 0.5) / 2^32))."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) without its text, with n_words,
    n_features, weight, score and rank: 1, 2, ... for the ``percent`` of the rows
    of at least ``least_words`` words that are drawn, null for the others."""
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = cut(weigh(docs.drop("score", "rank"), gains).withColumn("score", F.col("weight") + noise(seed)))
    able = F.col("n_words") >= least_words
    rows = rows.withColumn("_able", able)
    down = Window.orderBy(F.col("_score").desc())
    first = (rows.where("_able").groupBy(F.col("score").alias("_score")).agg(F.count(F.lit(1)).alias("_n"))
             .select("_score", F.coalesce(F.sum("_n").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"),
                     F.floor(F.sum("_n").over(Window.partitionBy()) * percent / 100).alias("_draws")))
    # one row a score, of which there are about 60,000 at most
    ranked = rows.join(F.broadcast(first), F.col("_able") & (F.col("score") == F.col("_score")), "left")
    own = F.row_number().over(Window.partitionBy("score", "_able").orderBy("doc_id"))
    rank = F.col("_first") + own
    return (ranked.withColumn("_rank", rank)
            .withColumn("rank", F.when(F.col("_able") & (F.col("_rank") <= F.col("_draws")), F.col("_rank")).cast("long"))
            .drop("_able", "_score", "_first", "_draws", "_rank"))


def drawn(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """The drawn rows of ``docs``, whole."""
    return docs.join(ranked.where("rank IS NOT NULL").select("doc_id").distinct(), "doc_id", "left_semi")
