"""Scoring by a log-bilinear language model trained with noise contrast.

Tokens are the words between white space, A-Z in lower case, then one end.
All tokens of the training documents are counted.  The outputs of the model
are the end, every word seen at least ``LEAST`` times (of those that go to
every task, see below) and "any other word"; its context is the two tokens
before.  The outputs, by falling count, are cut into about sqrt(outputs)
classes, the end and "any other word" being classes by themselves.  With
context vectors R, position weights c1, c2, class vectors K and output vectors
Q, the context of a token is x = c1 * R_a + c2 * R_b and

    log p(w | a, b) = log softmax_k(<x, K_k> + top_bias_k) at the class of w
                    + log softmax_v(<x, Q_v> + bias_v) over that class, at w

so a token needs two small normalisers, both computed in full, whatever the
number of words.  Few outputs are one class, and the first part is zero.
A word outside the vocabulary gets the probability of "any other word" times
its smoothed share among those, so probabilities of a context sum to one.

Training goes over all tokens of the training documents, written once as
output numbers and dealt by hash to tasks of about ``TASK_TOKENS`` tokens: each
takes AdaGrad steps on the noise-contrastive loss of the classes and of the
words in their class over its share and sends on the rows of the parameters
that it changed; a row's new value is the mean over the tasks that changed it.
This is done ``ROUNDS`` times.

Word counts: words frequent enough to be among about ``HEAD`` go to every task
(two numbers each, a fixed bound).  Rare words, none of them hot, are joined
by hash.  Words are told apart by 64-bit hashes; among n distinct words
n^2 / 2^65 pairs are expected to be confused.

Defined cases: null text counts as empty, one end token; without training rows
all counts are 0; a null doc_id counts as an empty id for its fold.  Rows
repeated are scored each and equally.  An empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
import hashlib
import math
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import cut, fold_crc, give_back, shuffles_once, small_batches, whole_text
from daybook.llm.near_dedup import WordHashes

LEAST, FLAT, DIM, NOISE, BATCH, ROUNDS, RATE = 5, 256, 16, 128, 2048, 3, 0.1
TASK_TOKENS, FAN_IN, HEAD = 1 << 22, 32, 1 << 19
DAMP = 1e-6  # AdaGrad sums start here, which slows rows seen seldom
END = b"\n"  # no word contains white space
_PIECE, _BLOCK, _CHUNK = 1 << 10, 1 << 13, 1 << 19  # tokens of one matrix product, rows of one block, tokens of one share
_BESIDE = 48  # outputs that are cheaper computed in vain than told apart
_DIMS = np.arange(DIM)


def words_of(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of a batch of texts, the number among them of every
    word, text by text, and how many each text has: ``tokens`` of all of them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, edges = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.greater(pc.binary_length(flat), 0)  # white space at either end leaves empty words
    lengths = np.diff(np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))][edges])
    coded = flat.filter(full).dictionary_encode()
    return coded.dictionary.cast(pa.binary()).to_pylist(), coded.indices.to_numpy(), lengths


def with_ends(values: np.ndarray, lengths: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """The values of the words with ``end`` after each text, and the lengths with it."""
    out, is_end = np.full(len(values) + len(lengths), end, values.dtype), np.zeros(len(values) + len(lengths), bool)
    is_end[np.cumsum(lengths + 1) - 1] = True
    out[~is_end] = values
    return out, lengths + 1


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


@contextmanager
def shared(spark: SparkSession, *parts):
    """A broadcast of arrays, whose copies on the disks of the driver and of
    the executors go at the end; inside a function they would stay behind."""
    sent = spark.sparkContext.broadcast(parts)
    try:
        yield sent
    finally:
        sent.destroy()


# ---- counts over the training documents

def word_counts(train: DataFrame) -> DataFrame:
    """(h, c): count of every token, by signed 64-bit hash."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for part in small_batches(batch, 1 << 24):
                ws, at, _ = words_of(part.column("text"))
                h, n = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws)), np.bincount(at, minlength=len(ws))
                h, n = np.r_[h, np.uint64(word_hash(END))], np.r_[n, part.num_rows]
                yield pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64)), "n": pa.array(n)})
        known.clear()
        give_back()
    return train.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("c"))


@dataclasses.dataclass
class Words:
    """The frequent words by rising hash, with counts and output numbers.

    Outputs: 0 the end, 1..size the vocabulary, size + 1 any other word;
    size + 2 stands before a text, in contexts only.
    """
    hashes: np.ndarray
    counts: np.ndarray
    output: np.ndarray
    size: int
    n: int  # training tokens
    v: int  # distinct ones

    @property
    def other(self) -> int:
        return self.size + 1

    def parts(self) -> tuple:
        return self.hashes, self.counts, self.output, self.size, self.n, self.v

    def unigram(self) -> np.ndarray:
        """Smoothed shares of the outputs."""
        c = np.zeros(self.size + 2)
        inside = self.output <= self.size
        c[self.output[inside]] = self.counts[inside]
        c[self.other] = self.n - c.sum()
        return (c + 0.1) / (c + 0.1).sum()


def _bucket():
    return F.floor(F.log2("c") * 16).cast("int")


def frequent(counts: DataFrame, vocab: int | None, head: int) -> tuple[Words, int]:
    """The words at or above the lowest count class that keeps them within
    ``head`` (a class spans a sixteenth of a power of two), and that class.
    The vocabulary is all of them seen ``LEAST`` times, or the first ``vocab``."""
    n, v = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    classes = {r["k"]: r["count"] for r in counts.groupBy(_bucket().alias("k")).count().collect()}
    least, total = 0, 0
    for k in sorted(classes, reverse=True):
        total += classes[k]
        if total > head:
            least = k + 1
            break
    t = counts.where(_bucket() >= least).select("h", "c").toArrow()
    h, c = t.column("h").to_numpy().view(np.uint64), t.column("c").to_numpy()
    order = np.argsort(h)
    h, c = h[order], c[order]
    is_end = h == np.uint64(word_hash(END))
    by_count = np.lexsort((h, -c))
    by_count = by_count[~is_end[by_count]]
    by_count = by_count[c[by_count] >= LEAST] if vocab is None else by_count[:vocab]
    output = np.full(len(h), len(by_count) + 1, np.int32)
    output[by_count] = np.arange(1, len(by_count) + 1)
    output[is_end] = 0
    return Words(h, c, output, len(by_count), int(n or 0), int(v or 0)), least


def places_of(hashes: np.ndarray, w: Words) -> np.ndarray:
    """Places among the frequent words, or -1."""
    if not len(w.hashes):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(w.hashes, hashes), len(w.hashes) - 1)
    return np.where(w.hashes[at] == hashes, at, -1)


def _outputs(places: np.ndarray, w: Words) -> np.ndarray:
    if not len(w.output):
        return np.full(len(places), w.other, np.int32)
    out = w.output[places]  # -1 reads the last one, put right below
    out[places < 0] = w.other
    return out


def _contexts(outputs: np.ndarray, lengths: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The two outputs before each token; ``lengths``: tokens of each document."""
    start = w.size + 2
    first = np.r_[0, np.cumsum(lengths)[:-1]]
    b = np.r_[np.int32(start), outputs[:-1]]
    b[first] = start
    a = np.r_[np.int32(start), b[:-1]]
    a[first] = start
    return a, b


def numbers(train: DataFrame, w: Words, words: Broadcast | None = None) -> DataFrame:
    """(k, ids): a hash of doc_id, and the outputs of the whole document, int32,
    which end with a 0.  ``words``: the parts of ``w``, sent already."""
    known = None if words else w

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, hashes = known or Words(*words.value), WordHashes()
        for batch in batches:
            for part in small_batches(batch):
                ws, at, lengths = words_of(part.column("text"))
                outputs = _outputs(places_of(np.fromiter(map(hashes.__getitem__, [*ws, END]), np.uint64, len(ws) + 1), w), w)
                ids, lengths = with_ends(outputs.take(at), lengths, outputs[-1])
                ends = np.r_[0, np.cumsum(lengths)]
                yield pa.RecordBatch.from_pydict({"k": part.column("k"), "ids": pa.array(
                    [ids[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:])], pa.binary())})
        hashes.clear()
        give_back()
    return train.select(F.xxhash64("doc_id").alias("k"), "text").mapInArrow(take, "k long, ids binary")


def class_edges(w: Words) -> np.ndarray:
    """First output of every class and, last, the number of outputs: classes
    hold about equal sums of the roots of the shares."""
    n = w.size + 2
    if n <= FLAT:
        return np.array([0, n])
    root = np.cumsum(np.sqrt(w.unigram()[1:w.other]))
    parts = math.isqrt(n)
    part = np.minimum((root / root[-1] * parts).astype(np.int64), parts - 1)
    return np.r_[0, 1 + np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), w.other, n]


# ---- the model

@dataclasses.dataclass
class Model:
    r: np.ndarray
    q: np.ndarray
    k: np.ndarray
    c: np.ndarray  # two rows, the position weights
    bias: np.ndarray
    top_bias: np.ndarray
    edges: np.ndarray  # of the classes, not learned

    @staticmethod
    def start(w: Words, seed: int = 5) -> Model:
        """Vectors near zero, so the first model is the unigram one."""
        rng, edges, share = np.random.default_rng(seed), class_edges(w), w.unigram()
        first = [np.empty((n, DIM), np.float32) for n in (w.size + 3, w.size + 2, len(edges) - 1)]
        for p in first:
            for at in range(0, len(p), _BLOCK):  # the same numbers as drawn at once
                p[at:at + _BLOCK] = rng.normal(0, 0.1, p[at:at + _BLOCK].shape)
        first += [x.astype(np.float32) for x in (np.ones((2, DIM)), np.log(share), np.log(np.add.reduceat(share, edges[:-1])))]
        return Model(*first, edges)

    def parts(self) -> list[np.ndarray]:
        return [self.r, self.q, self.k, self.c, self.bias, self.top_bias]

    def class_of(self, out: np.ndarray) -> np.ndarray:
        return np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges)).take(out)

    def wide(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The contexts, and a one by which biases are multiplied."""
        x = np.empty((len(a), DIM + 1), np.float32)
        np.multiply(self.r.take(a, 0), self.c[0], out=x[:, :DIM])
        x[:, :DIM] += self.c[1] * self.r.take(b, 0)
        x[:, DIM] = 1
        return x

    def log_probs(self, a: np.ndarray, b: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Natural log probability of every output after its (a, b)."""
        group, lp, top = self.class_of(out), np.zeros(len(out)), np.c_[self.k, self.top_bias]
        order = _by_class(group)  # the rows of one class lie together
        a, b, out, group = a.take(order), b.take(order), out.take(order), group.take(order)
        at = 0
        for end in np.r_[np.flatnonzero(np.diff(group)) + 1, len(out)][:len(out)]:
            lo, hi = self.edges[group[at]], self.edges[group[at] + 1]
            v = np.c_[self.q[lo:hi], self.bias[lo:hi]]
            step = max(64, min(_PIECE, (1 << 18) // int(hi - lo)))
            for i in (slice(x, min(x + step, end)) for x in range(at, end, step)):
                x = self.wide(a[i], b[i])
                if len(self.edges) > 2:
                    lp[i] = _log_softmax_at(x, top, group[i])
                if hi - lo > 1:
                    lp[i] += _log_softmax_at(x, v, out[i] - lo)
            at = end
        back = np.empty_like(lp)
        back[order] = lp
        return back

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a model of one class: A1 + bias, A2 and log normalisers, so that
        the natural log probability of w after (a, b) is t1[a, w] + t2[b, w] - z[a, b]."""
        if len(self.edges) > 2:
            raise ValueError("tables are of models of one class")
        r, q = self.r.astype(float), self.q.astype(float)
        t1, t2 = (r * self.c[0]) @ q.T + self.bias, (r * self.c[1]) @ q.T
        m1, m2 = t1.max(1, keepdims=True), t2.max(1, keepdims=True)
        z = np.log(np.exp(t1 - m1) @ np.exp(t2 - m2).T) + m1 + m2.T
        return t1, t2, z


def _by_class(group: np.ndarray) -> np.ndarray:
    """The stable order by class; numbers of 16 bits are sorted in linear time."""
    return np.argsort(group.astype(np.int16) if len(group) and group.max() < 1 << 15 else group, kind="stable")


def _log_softmax_at(x: np.ndarray, v: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log softmax, at ``at``, of the products of every row of ``x`` with the
    rows of ``v``."""
    s = x @ v.T
    if np.einsum("ij,ij->i", x, x).max() * np.einsum("ij,ij->i", v, v).max() > 3600:
        s -= s.max(1, keepdims=True)  # else all are within 60 and their exponentials in float32's range
    mine = s[np.arange(len(s)), at].astype(float)
    np.exp(s, out=s)
    return mine - np.log((s @ np.ones(s.shape[1], s.dtype)).astype(float))


def _add_up(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of the distinct rows, which do not fall, and the sums of
    their values, an even number of columns."""
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    # complex numbers add part by part, in half as many additions
    return first, np.add.reduceat(values.view(np.complex64), first, axis=0).view(np.float32)


def _scaled(g: np.ndarray, past: np.ndarray) -> np.ndarray:
    """AdaGrad's step for ``g``, whose square goes onto ``past``."""
    past += g * g
    g *= RATE
    g /= np.sqrt(past)
    return g


def train_share(model: Model, noise_share: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray, n: np.ndarray,
                seed: int, in_place: bool = False) -> Model:
    """One pass of AdaGrad steps on the noise-contrastive loss, rows weighted
    by n: batches of any rows for the classes, batches of the rows of one class
    for the words in it.  A step touches the rows of its batch only.  With
    ``in_place`` the arrays of ``model`` are those of the result.

    A noise output drawn several times is computed once and counts as often.
    Where a class has few outputs beyond those drawn, all are one product.
    """
    rng, edges = np.random.default_rng(seed), model.edges
    r, q, k, c, bias, top_bias = (p if in_place else p.copy() for p in model.parts())
    past_r, past_q, past_k, past_c, past_bias, past_top = (np.full_like(p, DAMP) for p in (r, q, k, c, bias, top_bias))
    group = model.class_of(w)
    top_share = np.add.reduceat(noise_share, edges[:-1])
    whole_row = np.dtype((np.void, r.itemsize * DIM))  # rows are written as one item each
    r_rows, past_rows = (p.view(whole_row).ravel() for p in (r, past_r))
    weighted = n.min() < n.max() if len(n) else False

    def noise_of(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(share), np.log(NOISE * share).astype(np.float32)

    def step(rows: np.ndarray, u: np.ndarray, v: np.ndarray, v_bias: np.ndarray, past_v: np.ndarray, past_b: np.ndarray,
             steps: np.ndarray, offset: np.ndarray, column: int, lo: int) -> None:
        """``rows``: a, b, output, class; ``v``: vectors of the outputs to choose
        among, of which ``rows`` has the number, from ``lo`` on, in ``column``."""
        x = np.minimum(np.searchsorted(steps, rng.random(NOISE), "right"), len(steps) - 1)
        times = np.bincount(x, minlength=len(v)).astype(np.float32)
        drawn, at = np.flatnonzero(times), rows[:, column] - lo
        every = len(v) <= len(drawn) + _BESIDE
        if every:
            drawn = slice(None)
        else:
            order = np.argsort(at)
            rows, at = rows.take(order, 0), at.take(order)
            u = u.take(order) if weighted else u
        u = (u / u.sum()).astype(np.float32)[:, None] if weighted else np.float32(1 / len(rows))
        ab = rows[:, :2].ravel()
        pairs = r.take(ab, 0)
        both = pairs.reshape(len(rows), 2 * DIM)
        mix = np.zeros((2 * DIM, DIM + 1), np.float32)
        mix[_DIMS, _DIMS], mix[_DIMS + DIM, _DIMS] = c
        wide = both @ mix  # the context and a one, by which the biases are multiplied
        wide[:, DIM] = 1
        ctx, noise, times = wide[:, :DIM], v[drawn], times[drawn]
        lose = wide @ np.c_[-noise, offset[drawn] - v_bias[drawn]].T
        np.exp(lose, out=lose)
        if every:
            each = np.arange(len(rows))
            gain = -1 / (1 + 1 / lose[each, at])
            lose += 1
            np.divide(times, lose, out=lose)
            lose[each, at] += gain
            lose *= u
            d_ctx, d, d_bias = lose @ noise, lose.T @ ctx, np.ones(len(rows), np.float32) @ lose
        else:
            mine = v.take(at, 0)
            gain = np.einsum("ij,ij->i", ctx, mine) + (v_bias - offset).take(at)
            gain = (-1 / (1 + np.exp(gain)))[:, None] * u
            lose += 1
            if weighted:
                np.divide(u, lose, out=lose)
            else:
                np.reciprocal(lose, out=lose)
                times = times * u
            d_ctx = lose @ (noise * times[:, None])
            mine *= gain
            d_ctx += mine
            first, sums = _add_up(at, ctx * gain)
            d, d_bias = np.zeros_like(v), np.bincount(at, gain[:, 0], len(v)).astype(np.float32)
            d[at[first]] = sums
            d[drawn] += (lose.T @ ctx) * times[:, None]
            d_bias[drawn] += (np.ones(len(rows), np.float32) @ lose) * times
        v -= _scaled(d, past_v)
        v_bias -= _scaled(d_bias, past_b)
        order = np.argsort(ab)
        ab = ab.take(order)
        first, d = _add_up(ab, (d_ctx @ mix[:, :DIM].T).reshape(len(ab), DIM).take(order, 0))
        ab = ab[first]
        now = past_r.take(ab, 0)
        new = pairs.take(order[first], 0)
        new -= _scaled(d, now)
        past_rows[ab], r_rows[ab] = now.view(whole_row).ravel(), new.view(whole_row).ravel()
        d = d_ctx.T @ both
        np.subtract(c, _scaled(np.stack([d[:, :DIM].diagonal(), d[:, DIM:].diagonal()]), past_c), out=c)

    order = rng.permutation(len(w))
    data = np.stack([a, b, w, group], axis=1).astype(np.int32).take(order, 0)
    n = n.take(order)
    batches = [(-1, slice(at, at + BATCH)) for at in range(0, len(w), BATCH)] if len(edges) > 2 else []
    order = _by_class(data[:, 3])
    by_class, by_n = data.take(order, 0), n.take(order)
    ends = np.r_[np.flatnonzero(np.diff(by_class[:, 3])) + 1, len(w)]
    shares: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    at = 0
    for end in ends[ends > 0]:
        g = int(by_class[at, 3])
        if edges[g + 1] - edges[g] > 1:
            share = noise_share[edges[g]:edges[g + 1]] / top_share[g]
            shares[g] = noise_of(share)
            batches += [(g, slice(x, min(x + BATCH, end))) for x in range(at, end, BATCH)]
        at = end
    top = noise_of(top_share)
    with np.errstate(over="ignore", divide="ignore"):  # a logistic value of 0 or 1
        for turn in rng.permutation(len(batches)):
            g, i = batches[turn]
            if g < 0:
                step(data[i], n[i], k, top_bias, past_k, past_top, *top, 3, 0)
            else:
                j = slice(edges[g], edges[g + 1])
                step(by_class[i], by_n[i], q[j], bias[j], past_q[j], past_bias[j], *shares[g], 2, edges[g])
    return Model(r, q, k, c, bias, top_bias, edges)


def changes(old: Model, new: Model, weight: float, lane: int) -> Iterator[pa.RecordBatch]:
    """The rows of the parameters that a pass has changed, with the changes in
    16 bits, a block of rows of one parameter at a time."""
    for k, (a, b) in enumerate(zip(old.parts(), new.parts())):
        a, b = a.reshape(len(a), -1), b.reshape(len(b), -1)
        rows = np.flatnonzero((a != b).any(1))
        for part in np.split(rows, np.flatnonzero(np.diff(rows // _BLOCK)) + 1) if len(rows) else ():
            yield _message(k, int(part[0]) // _BLOCK, lane, part, np.full(len(part), weight), (b[part] - a[part]).astype(np.float16))


def _message(k: int, block: int, lane: int, rows: np.ndarray, weights: np.ndarray, change: np.ndarray) -> pa.RecordBatch:
    data = {c: pa.array([x.tobytes()], pa.binary()) for c, x in
            (("rows", rows.astype(np.int32)), ("weights", weights.astype(np.float64)), ("change", change))}
    return pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "block": pa.array([block], pa.int32()),
                                       "lane": pa.array([lane], pa.int32()), "wide": pa.array([change.dtype == np.float32])} | data)


_MESSAGE = "k int, block int, lane int, wide boolean, rows binary, weights binary, change binary"


def merged(t: pa.Table) -> pa.Table:
    """The messages about one block as one: a row's change is the mean over
    those that changed it, by their weights."""
    k, block = t.column("k")[0].as_py(), t.column("block")[0].as_py()
    total, weight = None, np.zeros(_BLOCK)
    # in an order that does not depend on which task was ready first
    messages = sorted(zip(t.column("lane").to_pylist(), t.column("wide").to_pylist(), *(t.column(c).to_pylist() for c in ("rows", "weights", "change"))))
    for _, wide, rows, weights, change in messages:
        at, n = np.frombuffer(rows, np.int32) - block * _BLOCK, np.frombuffer(weights, np.float64)
        x = np.frombuffer(change, np.float32 if wide else np.float16).reshape(len(at), -1)
        total = np.zeros((_BLOCK, x.shape[1])) if total is None else total
        total[at] += n[:, None] * x
        weight[at] += n
    at = np.flatnonzero(weight)
    return pa.Table.from_batches([_message(k, block, 0, at + block * _BLOCK, weight[at], (total[at] / weight[at][:, None]).astype(np.float32))])


def train(ids: DataFrame, w: Words, task_tokens: int = TASK_TOKENS) -> Model:
    """The model after ROUNDS of passes over all tokens.

    Documents are dealt to tasks by hash, so many that each has about
    ``task_tokens`` tokens: what a task sees does not depend on the cluster.  A
    task sends on the rows that it changed, and these are merged block by block,
    ``FAN_IN`` tasks at a time.
    """
    model, share = Model.start(w), w.unigram()
    bare = dataclasses.replace(w, hashes=None, counts=None, output=None)  # the contexts need the size alone
    tasks = max(1, -(-w.n // task_tokens))
    spark = ids.sparkSession
    with shuffles_once(spark):
        rows = cut(ids.repartition(tasks, F.xxhash64("k", "ids")).sortWithinPartitions("k", "ids"))

    for turn in range(ROUNDS):
        with shared(spark, share, *model.parts(), model.edges) as sent, shuffles_once(spark):
            _pass(rows, bare, model, sent, turn, tasks)
        give_back()
    return model


def _pass(rows: DataFrame, w: Words, model: Model, sent: Broadcast, turn: int, tasks: int) -> None:
    """One pass, which changes ``model``; ``sent`` has the shares of the outputs
    and the model before.  The merged changes are written to the shared folder
    and come to the driver a partition at a time."""
    def one_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, model = sent.value[0], Model(*sent.value[1:])
        total, seen, now, held, size = 0.0, 0, model, [], 0
        for x in chain((x for batch in batches for x in batch.column("ids")), [None]):
            if x is not None:
                held.append(np.frombuffer(x.as_buffer(), np.int32))
                size += len(held[-1])
            if held and (x is None or size >= _CHUNK):
                out = np.concatenate(held)
                a, b = _contexts(out, np.array([len(d) for d in held]), w)
                seen, total, held, size = seen + 1, total + len(out), [], 0
                now = train_share(now, share, a, b, out, np.ones(len(out)), 1000 * turn + seen, in_place=now is not model)
                del out, a, b
        if seen:
            yield from changes(model, now, total, TaskContext.get().partitionId())
        del model, now, share
        give_back()

    got = rows.mapInArrow(one_pass, _MESSAGE)
    if tasks > FAN_IN:
        got = got.groupBy("k", "block", F.floor(F.col("lane") / FAN_IN).alias("_lane")).applyInArrow(merged, _MESSAGE)
    parts = model.parts()
    for m in cut(got.groupBy("k", "block").applyInArrow(merged, _MESSAGE).select("k", "rows", "change")).toLocalIterator():
        p = parts[m["k"]]
        at = np.frombuffer(m["rows"], np.int32)
        p[at] += np.frombuffer(m["change"], np.float32).reshape(len(at), *p.shape[1:])


# ---- scores

def score_rows(docs: DataFrame, words: Broadcast, sent: Broadcast) -> DataFrame:
    """One row a document: what the frequent words and the model give, and the
    rare words with their counts in the document.  ``known``, ``base`` and
    ``inner`` are sums over frequent words: c > 0, log10(c + 0.1), and the
    latter over words outside the vocabulary only.  ``words`` and ``sent``: the
    parts of the words and of the model."""
    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, model = Words(*words.value), Model(*sent.value)
        hashes = WordHashes()
        log_c = np.log10(np.r_[w.counts, 0] + 0.1)  # the last for -1
        for batch in batches:
            for part in small_batches(batch):
                ws, number, lengths = words_of(part.column("text"))
                h = np.fromiter(map(hashes.__getitem__, [*ws, END]), np.uint64, len(ws) + 1)
                place = places_of(h, w)
                # the rare words of each document, with their counts
                doc = np.repeat(np.arange(len(lengths)), lengths)
                rare = place.take(number) < 0
                pair, rare_n = np.unique(doc[rare] * len(ws) + number[rare], return_counts=True)
                doc, number_of = np.divmod(pair, max(len(ws), 1))
                ends = pa.array(np.searchsorted(doc, np.arange(len(lengths) + 1)).astype(np.int32))
                rare_h, rare_n = (pa.ListArray.from_arrays(ends, pa.array(x)) for x in (h.view(np.int64)[number_of], rare_n))
                at, lengths = with_ends(place.take(number), lengths, place[-1])
                out = _outputs(at, w)
                a, b = _contexts(out, lengths, w)
                first = np.r_[0, np.cumsum(lengths)[:-1]]
                rare, logs = at < 0, np.where(at < 0, 0.0, log_c[at])
                is_other = out == w.other
                lp = model.log_probs(a, b, out) / math.log(10)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "sig": part.column("sig"), "n_tokens": pa.array(lengths.astype(np.int64)),
                    "known": pa.array(np.add.reduceat((~rare).astype(np.int64), first)),
                    "base": pa.array(np.add.reduceat(logs, first)),
                    "inner": pa.array(np.add.reduceat(np.where(is_other, logs, 0.0), first)),
                    "others": pa.array(np.add.reduceat(is_other.astype(np.int64), first)),
                    "model": pa.array(np.add.reduceat(lp, first)),
                    "rare_h": rare_h, "rare_n": rare_n})
        hashes.clear()
        give_back()
    rows = docs.select("doc_id", F.xxhash64("text").alias("sig"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(rate, f"doc_id {id_type}, sig long, n_tokens long, known long, base double, inner double, "
                                 "others long, model double, rare_h array<long>, rare_n array<long>")


def score(docs: DataFrame, vocab: int | None = None, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and
    per_token of every row of ``docs``, learning from the folds 1 to 9."""
    base = docs.select("doc_id", whole_text().alias("text"))
    training = base.where(fold_crc("doc_id", 10) != 0)
    spark = docs.sparkSession
    with shuffles_once(spark):
        counts = cut(word_counts(training))
        w, least = frequent(counts, vocab, head)
    with shared(spark, *w.parts()) as words:
        model = train(numbers(training, w, words), w)
        with shared(spark, *model.parts(), model.edges) as sent:
            rows = cut(score_rows(base, words, sent))

    # rare words: those below the class of the frequent ones, and unseen ones
    rare = (rows.select("doc_id", "sig", F.explode(F.arrays_zip("rare_h", "rare_n")).alias("x"))
            .select("doc_id", "sig", F.col("x.rare_h").alias("h"), F.col("x.rare_n").alias("n"))
            .join(counts.where(_bucket() < least), "h", "left"))
    log_c = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.1)
    zero, none = F.lit(0).cast("long"), F.lit(0.0)
    parts = rows.select("doc_id", "sig", F.lit(1).alias("copies"), "n_tokens", "known", "base", "inner", "others", "model")
    extra = rare.select("doc_id", "sig", F.lit(0).alias("copies"), zero.alias("n_tokens"),
                        F.when(F.col("c") > 0, F.col("n")).otherwise(zero).alias("known"),
                        log_c.alias("base"), log_c.alias("inner"), zero.alias("others"), none.alias("model"))
    # equal rows under one doc_id meet here: sums of all of them, by their number
    sums = parts.unionByName(extra).groupBy("doc_id", "sig").agg(
        *[F.sum(c).alias(c) for c in ("copies", "n_tokens", "known", "base", "inner", "others", "model")])
    each = sums.select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"),
                       *[(F.col(c) / F.col("copies")).alias(c) for c in ("n_tokens", "known", "base", "inner", "others", "model")])
    inside = int(w.counts[w.output <= w.size].sum())
    n_other, v_other = w.n - inside, w.v - int((w.output <= w.size).sum())
    per_word = math.log10(w.n + 0.1 * (w.v + 1))
    per_other = math.log10(n_other + 0.1 * (v_other + 1))
    total = F.col("model") + F.col("inner") - F.col("others") * per_other
    return each.select(
        "doc_id", (fold_crc("doc_id", 10) == 0).alias("held_out"), F.col("n_tokens").cast("long").alias("n_tokens"),
        F.col("known").cast("long").alias("n_known"), F.lit(w.n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * per_word).alias("base_score"), total.alias("score"),
        (total / F.col("n_tokens")).alias("per_token"))
