"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: every word (without marks at its ends, A-Z in
lower case) and the word's first 3, 4 and 5 characters, hashed into ``SPACE``
numbers.  The machine scores bias + sum of weights + all pairwise products
<v_i, v_j> of present terms, computed as (|sum v|^2 - sum |v|^2) / 2, so a
pair of terms can count where neither does alone.

It is fitted in numpy on at most ``SAMPLE_TOXIC`` toxic and ``SAMPLE_CLEAN``
other labelled rows of the training folds (chosen by hash of doc_id).  Every
term seen in at least ``LEAST_ROWS`` of them gets a weight and a vector.  Some
count in full, whatever the text's length: terms whose share differs between
the classes by ``LEAST_Z`` standard errors, and terms of a telling pair.  A pair
tells if the toxic share of the rows with both terms lies ``PAIR_Z`` standard
errors outside the shares that either term, and all rows, show, so both terms
may be as frequent in both classes.  Pairs are looked at among terms in at
least ``PAIR_SHARE`` of the rows, in blocks of a matrix product.  All other terms
count by the root of their number in the text, so a long text is not swamped by
its ordinary words.  Whole texts are scored.

Defined cases: null text counts as empty; an empty text gets the score of the
bias.  Without training rows of both classes every score is the share of toxic
rows seen (0.0 without any).  Labels that are null are no training rows; a row
with a null doc_id has no label and the fold of an empty id.  Rows repeated
are scored each.  Extra columns pass ``score_documents``; a column that
clashes with a result column is replaced.
"""

from __future__ import annotations

import dataclasses
from array import array
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import fold_crc, give_back, small_batches, whole_text

SAMPLE_TOXIC, SAMPLE_CLEAN = 3000, 6000
SPACE, LEAST_ROWS, LEAST_Z, RANK, EPOCHS = 1 << 18, 2, 4.0, 8, 30
PAIR_SHARE, PAIR_Z, _BLOCK = 0.05, 12.0, 512
PLAIN_DECAY = 1e-2  # pull to zero of the weights that do not count in full
_CACHE = 1 << 19
_MARKS = ".,;:!?|#&%$*\"'()[]{}<>"


def word_terms(word: str) -> list[int]:
    bare = word.strip(_MARKS)
    parts = {f"w{bare}"} | {f"p{bare[:k]}" for k in (3, 4, 5) if len(bare) >= k} if bare else set()
    return [crc32(p.encode()) % SPACE for p in parts]


class TermIndex(dict):
    """Packed int32 terms of a word, remembered while there is room; with
    ``column`` (a term's place in the model or -1) only the places kept."""

    def __init__(self, column: np.ndarray | None = None):
        super().__init__()
        self.place = None
        if column is not None:
            kept = np.flatnonzero(column >= 0)
            self.place = dict(zip(kept.tolist(), column[kept].tolist()))

    def __missing__(self, word: bytes) -> bytes:
        terms = word_terms(word.decode("utf-8", "replace"))
        if self.place is not None:
            terms = [self.place[t] for t in terms if t in self.place]
        if len(self) >= _CACHE:
            self.clear()
        self[word] = packed = array("i", terms).tobytes()
        return packed


def present(text: str, index: TermIndex) -> np.ndarray:
    return np.unique(np.frombuffer(b"".join(map(index.__getitem__, text.encode().lower().split())), np.int32))


@dataclasses.dataclass
class Machine:
    column: np.ndarray  # term -> place in the model, or -1
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    full: int = 0  # the places before this one count in full

    def values(self, places: np.ndarray) -> np.ndarray:
        """What each present term counts."""
        plain = places >= self.full
        return np.where(plain, 1 / np.sqrt(1 + plain.sum()), 1.0)

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        for i, places in enumerate(rows):
            if len(places):
                x = self.values(places)
                v = x[:, None] * self.factors[places]
                s = v.sum(0)
                out[i] += x @ self.weights[places] + 0.5 * (s @ s - (v * v).sum())
        return out


def telling_pairs(rows: list[np.ndarray], labels: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Those of ``terms`` that are in a telling pair."""
    place = np.full(SPACE, -1, np.int32)
    place[terms] = np.arange(len(terms))
    present_in = np.zeros((len(terms), len(rows)), bool)
    for i, r in enumerate(rows):
        at = place[r]
        present_in[at[at >= 0], i] = True
    y, share = labels.astype(np.float32), float(labels.mean())
    own = np.array([x[labels == 1].sum() / max(1, x.sum()) for x in present_in], np.float32)
    told = np.zeros(len(terms), bool)
    for a in range(0, len(terms), _BLOCK):
        left = present_in[a:a + _BLOCK].astype(np.float32)
        for b in range(a, len(terms), _BLOCK):
            right = present_in[b:b + _BLOCK].astype(np.float32)
            both, toxic = left @ right.T, (left * y) @ right.T
            low = np.minimum(np.minimum(own[a:a + _BLOCK, None], own[None, b:b + _BLOCK]), share)
            high = np.maximum(np.maximum(own[a:a + _BLOCK, None], own[None, b:b + _BLOCK]), share)
            # rows beyond the nearest of the three shares, in standard errors of the rows with both
            over = np.maximum(toxic - high * both, low * both - toxic)
            i, j = np.nonzero(over > PAIR_Z * np.sqrt(share * (1 - share) * both))
            told[a + i] = told[b + j] = True
    return terms[told]


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 4) -> Machine:
    """The machine for rows of present terms and labels 0 or 1."""
    column = np.full(SPACE, -1, np.int32)
    n1, n0 = int(labels.sum()), int(len(labels) - labels.sum())
    if not n1 or not n0:
        share = n1 / (n1 + n0) if n1 + n0 else 0.0
        bias = -np.inf if share == 0 else np.inf
        return Machine(column, bias, np.zeros(0), np.zeros((0, RANK)))
    seen1 = np.bincount(np.concatenate([r for r, y in zip(rows, labels) if y] or [[]]).astype(np.int64), minlength=SPACE)
    seen0 = np.bincount(np.concatenate([r for r, y in zip(rows, labels) if not y] or [[]]).astype(np.int64), minlength=SPACE)
    p = (seen1 + seen0) / (n1 + n0)
    z = np.abs(seen1 / n1 - seen0 / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    z[(seen1 + seen0) < LEAST_ROWS] = -1
    plain = np.flatnonzero((z >= 0) & (z < LEAST_Z) & (p >= PAIR_SHARE) & (p < 1))
    z[telling_pairs(rows, labels, plain)] = LEAST_Z
    best = np.argsort(-z, kind="stable")[:int((z >= 0).sum())]
    column[best] = np.arange(len(best))
    rng = np.random.default_rng(seed)
    m = Machine(column, float(np.log(n1 / n0)), np.zeros(len(best)), rng.normal(0, 0.05, (len(best), RANK)), int((z >= LEAST_Z).sum()))
    places = [c[c >= 0] for c in (column[r] for r in rows)]
    values = [m.values(c).astype(np.float32) for c in places]
    theta = np.c_[m.weights, m.factors].astype(np.float32)
    first, second, last = np.zeros_like(theta), np.zeros_like(theta), np.zeros(len(best), np.float32)
    bias, bias_first, bias_second = m.bias, 0.0, 0.0
    y, step = labels.astype(float), 0
    weight = np.where(labels == 1, 0.5 * len(y) / n1, 0.5 * len(y) / n0)
    weight = weight / weight.mean()
    decay = np.full((len(best), 1 + RANK), 1e-3, np.float32)
    decay[:, 0] = np.where(np.arange(len(best)) < m.full, 1e-4, PLAIN_DECAY)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 256):
            pick, step = order[at:at + 256], step + 1
            at_row = np.repeat(np.arange(len(pick)), [len(places[i]) for i in pick])
            c, x = np.concatenate([places[i] for i in pick]), np.concatenate([values[i] for i in pick])
            by_term = np.argsort(c, kind="stable")
            starts = np.flatnonzero(np.diff(c[by_term], prepend=-1))
            used = c[by_term][starts]
            xt = x[:, None] * theta[c]
            sums = np.zeros((len(pick), 1 + RANK), np.float32)
            own = np.zeros(len(pick), np.float32)
            if len(c):
                filled = np.flatnonzero(np.diff(at_row, prepend=-1))
                sums[at_row[filled]] = np.add.reduceat(xt, filled, axis=0)
                own[at_row[filled]] = np.add.reduceat(np.einsum("ij,ij->i", xt[:, 1:], xt[:, 1:]), filled)
            logit = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - own)
            err = weight[pick] * (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[pick]) / len(pick)
            if len(c):
                pull = sums[at_row] - xt
                pull[:, 0] = 1
                pull *= (err.astype(np.float32)[at_row] * x)[:, None]
                # a step touches the terms of its rows only; what rested decays by the steps between
                now, rest = theta[used], (step - last[used])[:, None]
                last[used] = step
                grad = np.add.reduceat(pull[by_term], starts, axis=0) + rest * decay[used] * now
                first[used] = f = np.float32(0.9) ** rest * first[used] + np.float32(0.1) * grad
                second[used] = g = np.float32(0.999) ** rest * second[used] + np.float32(0.001) * grad * grad
                theta[used] = now - np.float32(0.02) * (f / (1 - 0.9 ** step)) / (np.sqrt(g / (1 - 0.999 ** step)) + np.float32(1e-8))
            bias_first, bias_second = 0.9 * bias_first + 0.1 * err.sum(), 0.999 * bias_second + 0.001 * err.sum() ** 2
            bias -= 0.02 * (bias_first / (1 - 0.9 ** step)) / (np.sqrt(bias_second / (1 - 0.999 ** step)) + 1e-8)
    # the classes weigh alike in training, so 0.5 splits them
    return dataclasses.replace(m, bias=float(bias), weights=theta[:, 0].copy(), factors=theta[:, 1:].copy())


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, label and present terms (packed int32) of the bounded sample."""
    usable = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(fold_crc("doc_id", 5) != 0)
    usable = usable.select("doc_id", F.col("toxic").cast("int").alias("_label")).withColumn("_order", F.xxhash64("doc_id"))
    toxic = usable.where("_label = 1").orderBy("_order", "doc_id").limit(SAMPLE_TOXIC)
    clean = usable.where("_label = 0").orderBy("_order", "doc_id").limit(SAMPLE_CLEAN)
    chosen = toxic.unionByName(clean).groupBy("doc_id").agg(F.max("_label").alias("_label"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TermIndex()
        for b in chain.from_iterable(map(small_batches, batches)):
            terms = [present(t.as_py(), index).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "label": b.column("_label"), "terms": pa.array(terms, pa.binary())})
        index.clear()
        give_back()

    # the sample is bounded by its two parameters, so it may be broadcast
    return (docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
            .mapInArrow(take, "doc_id long, label int, terms binary").dropDuplicates(["doc_id"]))


def learn(docs: DataFrame, labels: DataFrame) -> Machine:
    """The machine fitted by one task on the sample; only its terms, weights
    and vectors (at most 40 bytes for each of ``SPACE`` terms) come back."""
    def fit_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(i.as_py(), y.as_py(), np.frombuffer(t.as_buffer(), np.int32)) for b in batches
                for i, y, t in zip(b.column("doc_id"), b.column("label"), b.column("terms"))]
        rows.sort(key=lambda r: r[0])
        m = fit([r[2] for r in rows], np.array([r[1] for r in rows], np.int64))
        del rows
        give_back()
        terms = np.flatnonzero(m.column >= 0)
        terms = terms[np.argsort(m.column[terms])].astype(np.int32)
        yield pa.RecordBatch.from_pydict({
            "bias": pa.array([m.bias], pa.float64()), "full": pa.array([m.full], pa.int32()), "terms": pa.array([terms.tobytes()], pa.binary()),
            "weights": pa.array([m.weights.astype(np.float32).tobytes()], pa.binary()),
            "factors": pa.array([m.factors.astype(np.float32).tobytes()], pa.binary())})

    got = (training_rows(docs, labels).repartition(1)
           .mapInArrow(fit_one, "bias double, full int, terms binary, weights binary, factors binary").collect())
    if not got:
        return fit([], np.zeros(0, np.int64))
    m, column = got[0], np.full(SPACE, -1, np.int32)
    terms = np.frombuffer(m["terms"], np.int32)
    column[terms] = np.arange(len(terms), dtype=np.int32)
    return Machine(column, m["bias"], np.frombuffer(m["weights"], np.float32), np.frombuffer(m["factors"], np.float32).reshape(-1, RANK), m["full"])


def score_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with score and predicted, from whole texts alone."""
    base = docs.drop("score", "predicted")
    names = base.columns

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TermIndex(machine.column)
        for b in chain.from_iterable(map(small_batches, batches)):
            logit = machine.logits([present(t.as_py() or "", index) for t in b.column("text")])
            with np.errstate(over="ignore"):
                score = 1 / (1 + np.exp(-logit))
            yield pa.RecordBatch.from_pydict({c: b.column(c) for c in names} | {
                "score": pa.array(score, pa.float64()), "predicted": pa.array((score >= 0.5).astype(np.int32), pa.int32())})
        index.clear()
        give_back()

    return base.mapInArrow(rate, T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType()),
                                               T.StructField("predicted", T.IntegerType())]))
