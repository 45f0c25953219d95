"""Periodic runs of words by internal pattern matching.

A run is a stretch of consecutive words with smallest period q, at least
``LEAST`` words and ``TIMES`` periods long, that no neighbouring word extends
keeping the period.  Every run is found without trying periods one by one:

1. Names.  Doubling gives every position, at every level k, the name of the
   block of 2^k words that starts there; equal blocks have equal names.  Only
   positions whose block is met again in the document are sorted further, and
   the last order is the suffix array.
2. Occurrences.  A run of period q, 2^k <= q < 2^(k+1), holds a whole block of
   2^k words that starts at a multiple of 2^k, and the same block q words
   later.  So each such (dyadic) block asks for its occurrences that start
   2^k to 2^(k+1) - 1 words later.  The suffix array's entries that begin with
   the block are one range; its least entry at or after a position is a range
   successor query on a wavelet tree over the suffix array.  Blocks of one word
   are left out: those of two serve the periods 1 to 3.
3. Candidates.  Occurrences in a window no longer than two blocks form one
   arithmetic progression.  Up to two occurrences are candidates by their
   distance.  Three or more have the block's own period d as their difference;
   the stretch of period d around the block ends where the run's first period
   is interrupted, and the stretch around the progression ends q words later,
   so the two ends give the one candidate.
4. Each candidate is extended to both sides by binary lifting over the names,
   and kept if it is long enough; of equal stretches the smallest period stays.

All steps are array operations over many documents at once (about
``BATCH_WORDS`` words; a longer document is a batch by itself, whole, and takes
about 4 bytes a word and level).  Names are per document, so nothing is
compared between documents.

Defined cases: null, empty and blank texts have no words and no runs; rows
repeated or tied are treated each and equally; of runs equally long the first
start, then the smallest period is reported; an empty table gives an empty
result; extra columns pass, and a column that clashes with a result column is
replaced.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LEAST, TIMES = 6, 4
BATCH_WORDS = 1 << 18


# ---- names of blocks and the suffix array

def codes_of(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words, equal only for equal words of one document, and
    the documents' starts (with the end, last)."""
    starts = np.r_[0, np.cumsum([len(d) for d in documents])].astype(np.int64)
    codes, at = np.empty(starts[-1], np.int64), 0
    for d, lo, hi in zip(documents, starts.tolist(), starts[1:].tolist()):
        numbers = defaultdict(itertools.count(at).__next__)
        codes[lo:hi] = np.fromiter(map(numbers.__getitem__, d), np.int64, hi - lo)
        at += len(numbers)
    return codes, starts


class Blocks:
    """Names of all blocks of 2^k words, and the order of the suffixes whose
    first two words are met again."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray):
        n = len(codes)
        kind = np.int32 if n < 1 << 30 else np.int64
        self.starts = starts
        self.ends = np.repeat(starts[1:], np.diff(starts)).astype(kind)  # of each word's document
        self.order = np.empty(0, kind)  # the suffix array of repeated blocks
        self.names = [np.r_[codes, -1].astype(kind)]  # by level; the last is no word's
        self.sizes = [np.ones(0, kind)]  # by level: of the range of a name that is a place in the order
        live, places, reach = np.arange(n), np.arange(n), 1
        while len(live):
            name = self.names[-1]
            after = np.where(live + reach < self.ends[live], name[np.minimum(live + reach, n)].astype(np.int64) + 1, 0)
            key = name[live].astype(np.int64) * (2 * n + 2) + after
            sort = np.argsort(key)
            live, key = live[sort], key[sort]
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            group = np.r_[new[1:], len(key)] - new
            if reach == 1:  # blocks met once have names that no place in the order has
                live, group = live[np.repeat(group > 1, group)], group[group > 1]
                name = np.r_[n + np.arange(n), -1].astype(kind)
                self.order, places = np.empty(len(live), kind), np.arange(len(live))
            else:
                name = name.copy()
            # a block's name is the place in the order of the first suffix that begins with it
            head = np.cumsum(group) - group
            self.order[places] = live
            name[live] = np.repeat(places[head], group)
            size = np.ones(len(self.order), kind)
            size[places[head]] = group
            self.names.append(name)
            self.sizes.append(size)
            # suffixes apart from all others have their place and rest
            again = np.repeat(group > 1, group)
            live, places = live[again], places[again]
            reach *= 2

    def repeated(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Dyadic blocks of a level that are met again, and their ranges."""
        width, lengths = 1 << level, np.diff(self.starts)
        many = -(-lengths // width)
        first = np.cumsum(many) - many
        at = np.repeat(self.starts[:-1], many) + width * (np.arange(int(many.sum())) - np.repeat(first, many))
        name = self.names[level][at]
        inside = name < len(self.order)
        at, name = at[inside], name[inside].astype(np.int64)
        size = self.sizes[level][name]
        again = size > 1
        return at[again], name[again], (name + size)[again]

    def same_after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes at i and j (i < j) share."""
        n, out = len(self.names[0]) - 1, np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name = self.names[k]
            equal = name[np.minimum(i + out, n)] == name[np.minimum(j + out, n)]
            out += equal * (1 << k)
        return out

    def same_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the prefixes before i and j (i < j) share at their ends."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, x = self.names[k], i - out - (1 << k)
            equal = (x >= 0) & (name[np.maximum(x, 0)] == name[np.maximum(j - out - (1 << k), 0)])
            out += equal * (1 << k)
        return out


# ---- range successors

class WaveletTree:
    """Levels of bits of the values, most significant first; below each bit the
    zeros stand before the ones, in their order.  Queries are arrays."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), []
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b & 1).astype(bool)
            zeros = np.r_[0, np.cumsum(~one)].astype(np.int32)
            self.levels.append((b, zeros))
            values = np.concatenate([values[~one], values[one]])

    def less(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values in [lo, hi) are under x."""
        out = np.zeros(len(x), np.int64)
        over = x >> self.bits > 0
        out[over] = (hi - lo)[over]
        x = np.where(over, 0, x)
        for b, zeros in self.levels:
            z0, z1 = zeros[lo], zeros[hi]
            one = (x >> b & 1).astype(bool)
            out += np.where(one, z1 - z0, 0)
            lo = np.where(one, zeros[-1] + lo - z0, z0)
            hi = np.where(one, zeros[-1] + hi - z1, z1)
        return out

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) value in [lo, hi), k under its length."""
        out = np.zeros(len(k), np.int64)
        for b, zeros in self.levels:
            z0, z1 = zeros[lo], zeros[hi]
            one = k >= z1 - z0
            k = np.where(one, k - (z1 - z0), k)
            out |= one.astype(np.int64) << b
            lo = np.where(one, zeros[-1] + lo - z0, z0)
            hi = np.where(one, zeros[-1] + hi - z1, z1)
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least value >= x in [lo, hi), or -1."""
        below = self.less(lo, hi, x)
        out = np.full(len(x), -1, np.int64)
        some = np.flatnonzero(below < hi - lo)
        if len(some):
            out[some] = self.kth(lo[some], hi[some], below[some])
        return out


# ---- runs

def candidates(blocks: Blocks) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) pairs to be checked."""
    tree, found = WaveletTree(blocks.order), []
    n = len(blocks.ends)
    for k in range(1, len(blocks.names)):
        width = 1 << k
        least = 1 if k == 1 else width
        s, lo, hi = blocks.repeated(k)
        if not len(s):
            continue
        stop = s + 2 * width
        one = tree.successor(lo, hi, s + least)
        near = (one >= 0) & (one < stop)
        s, lo, hi, stop, one = s[near], lo[near], hi[near], stop[near], one[near]
        found.append((s, one - s))
        two = tree.successor(lo, hi, one + 1)
        near = (two >= 0) & (two < stop)
        s, lo, hi, stop, one, two = s[near], lo[near], hi[near], stop[near], one[near], two[near]
        found.append((s, two - s))
        three = tree.successor(lo, hi, two + 1)
        near = (three >= 0) & (three < stop)
        s, one, d = s[near], one[near], (two - one)[near]
        if len(s):  # a progression: where the block's own period ends, here and there
            here = s + d + blocks.same_after(s, s + d)
            there = one + d + blocks.same_after(one, one + d)
            far = there > here
            found.append((s[far], (there - here)[far]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at, period = (np.concatenate(x) for x in zip(*found))
    return at[at + period < n], period[at + period < n]


def find_runs(codes: np.ndarray, starts: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (document, start in it, length, period) by document, start, period.
    ``times`` is 4 at least, which the blocks' sizes rest on."""
    if times < 4 or least < 6:
        raise ValueError("runs of at least 4 periods and 6 words are found")
    blocks = Blocks(codes, starts)
    at, period = candidates(blocks)
    back = blocks.same_before(at, at + period)
    length = back + blocks.same_after(at, at + period) + period
    long = length >= np.maximum(least, times * period)
    start, length, period = (at - back)[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][:len(start)]
    start, length, period = start[new], length[new], period[new]
    doc = np.searchsorted(starts, start, "right") - 1
    order = np.lexsort((period, start))
    return np.stack([doc, start - starts[doc], length, period], axis=1)[order]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run (start, length, period) holds after
    its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    gone = np.cumsum(drop[:-1]) > 0
    return [w for w, x in zip(words, gone.tolist()) if not x]


def runs_of_all(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each document's runs."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    for doc, start, length, period in find_runs(*codes_of(documents)).tolist():
        out[doc].append((start, length, period))
    return out


RUN_COLUMNS = [
    ("n_words", T.LongType()), ("n_runs", T.LongType()), ("start", T.LongType()), ("length", T.LongType()),
    ("period", T.LongType()), ("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
    ("collapsed", T.StringType())]


def detect(docs: DataFrame, id_column: str = "doc_id",
           before: Callable[[list[list[bytes]], list], list[list[bytes]]] | None = None,
           digests: bool = False) -> DataFrame:
    """``docs`` with the number of words and of runs, the longest run (null
    without any), all runs, and the text with each run's later periods left out
    (kept words joined by one space).  With ``digests`` the last two are SHA-256
    in hex instead, ``runs_sha256`` and ``collapsed_sha256``, so whole texts
    don't leave the task.  ``before(words, ids)`` may change the words."""
    columns = RUN_COLUMNS if not digests else [
        *RUN_COLUMNS[:5], ("runs_sha256", T.StringType()), ("collapsed_sha256", T.StringType())]
    base = docs.drop(*[c for c, _ in columns])
    schema = T.StructType([*base.schema.fields, *[T.StructField(c, t) for c, t in columns]])
    if digests:
        schema = T.StructType([f for f in schema.fields if f.name != "text"])
    names = [f.name for f in schema.fields][:-len(columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([])
        for c, t in columns:
            kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])) if c == "runs" else (
                pa.string() if isinstance(t, T.StringType) else pa.int64())
            arrow = arrow.append(pa.field(c, kind))
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                words: list[list[bytes]] = []
                total, end = 0, at
                while end < batch.num_rows and (end == at or total < BATCH_WORDS):
                    words.append((batch.column("text")[end].as_py() or "").encode().split())
                    total += len(words[-1])
                    end += 1
                part = batch.slice(at, end - at)
                at = end
                if before is not None:
                    words = before(words, part.column(id_column).to_pylist())
                rows = []
                for ws, runs in zip(words, runs_of_all(words)):
                    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
                    kept = b" ".join(collapse(ws, runs) if runs else ws)
                    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
                    last = ((hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest()) if digests else
                            ([dict(zip(("start", "length", "period"), r)) for r in runs], kept.decode()))
                    rows.append((len(ws), len(runs), *best, *last))
                new = {f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)}
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in names} | new)
    return base.mapInArrow(run, schema)
