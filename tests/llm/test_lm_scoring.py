"""Language-model scores: exact unigram base, probabilities that sum to one."""

import collections
import math
import os
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import lm_scoring as lm
from daybook.llm.near_dedup import tokens

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("vocab,head", [(1024, 1 << 19), (60, 200)])
def test_base_score_is_exact(make, rows, vocab, head):
    rows = rows[:400]
    tokens = {i: t.encode().lower().split() + [b"\n"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    got = lm.score(make(rows), vocab, head).collect()
    assert len(got) == len(rows)
    for r in got:
        ws = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel_tol=1e-9)


def test_model_beats_the_unigram_base_on_held_out_text(make, rows):
    got = [r for r in lm.score(make(rows)).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert sum(r["score"] > r["base_score"] for r in got) / len(got) > 0.7


def test_tables_are_normalised_and_training_lowers_the_loss():
    rng = np.random.default_rng(1)
    w = lm.Words(np.arange(21, dtype=np.uint64), np.r_[50, np.full(20, 100)], np.r_[0, np.arange(1, 21)].astype(np.int32), 20, 2500, 40)
    a, b = rng.integers(0, 23, 4000), rng.integers(0, 23, 4000)
    out = (b % 22).astype(np.int64)  # the next token is told by the last
    m = lm.Model.start(w)

    def mean_log(m):
        t1, t2, z = m.tables()
        p = t1[a, out] + t2[b, out] - z[a, b]
        full = np.exp(t1[3] + t2[5] - z[3, 5])
        assert abs(full.sum() - 1) < 1e-9
        return p.mean()
    before = mean_log(m)
    for turn in range(60):
        m = lm.train_share(m, w.unigram(), a, b, out, np.ones(4000), turn)
    assert mean_log(m) > before + 1


def test_repeated_rows_score_alike(make):
    got = lm.score(make([(1, "a b c"), (1, "a b c"), (2, "z"), (3, None)]), 2, 2).collect()
    assert len(got) == 4
    assert len({(r["score"], r["n_tokens"], r["n_known"]) for r in got if r["doc_id"] == 1}) == 1


def test_every_word_seen_often_has_an_output_and_classes_sum_to_one():
    counts = np.r_[500, np.arange(4000, 1000, -1)]
    w = lm.Words(np.arange(3001, dtype=np.uint64), counts, np.arange(3001).astype(np.int32), 3000, int(counts.sum()) + 90, 3050)
    m = lm.Model.start(w)
    m.r[7], m.q[:] = 2, np.random.default_rng(1).normal(0, 1, m.q.shape)
    m.k[:] = np.random.default_rng(2).normal(0, 1, m.k.shape)
    every = np.arange(w.size + 2)
    assert len(m.edges) > 30 and (np.diff(m.edges) > 0).all() and m.edges[-1] == len(every)
    p = m.log_probs(np.full(len(every), 7), np.full(len(every), 9), every)
    assert abs(np.exp(p).sum() - 1) < 1e-4 and p.std() > 0.5


def test_pairs_of_words_beyond_the_first_thousand_are_learned(make):
    rng, rows, fits = np.random.default_rng(3), [], {}
    for i in range(600):
        held, ws = zlib.crc32(str(i).encode()) % 10 == 0, []
        fits[i] = not held or len(rows) % 2 == 0
        for _ in range(40):
            left, right = rng.integers(0, 2), rng.integers(0, 150, 2)
            ws += [f"often{j}" for j in rng.integers(0, 1100, 4)]
            ws += [f"left{left}x{right[0]}", f"right{left if fits[i] else 1 - left}x{right[1]}"]
        rows.append((i, " ".join(ws)))
    got = [(r["per_token"], fits[r["doc_id"]]) for r in lm.score(make(rows)).collect() if r["held_out"]]
    mean = [np.mean([p for p, f in got if f is which]) for which in (False, True)]
    assert mean[1] - mean[0] > 0.05


def test_training_does_not_depend_on_how_the_rows_lie(make):
    rng = random.Random(21)
    rows = [(i, " ".join(rng.choice("abcdefghij") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 60)))) for i in range(200)]
    train = make(rows)
    w, _ = lm.frequent(lm.word_counts(train), None, 1 << 10)
    models = [lm.train(lm.numbers(df, w), w, task_tokens=900) for df in (train.repartition(1), make(rows[::-1]).repartition(5))]
    assert -(-w.n // 900) > 3  # several tasks, whose changes are merged
    for a, b in zip(models[0].parts(), models[1].parts()):
        assert (a == b).all()


def test_merged_changes_are_the_mean_over_the_tasks_that_made_them():
    w = lm.Words(np.arange(21, dtype=np.uint64), np.r_[50, np.full(20, 100)], np.r_[0, np.arange(1, 21)].astype(np.int32), 20, 2500, 40)
    old, rng = lm.Model.start(w), np.random.default_rng(3)
    sent, sums, weight = [], {}, {}
    for lane in range(70):
        new = lm.Model(*[p.copy() for p in old.parts()], old.edges)
        for row in rng.choice(22, 3, replace=False):
            change = rng.normal(size=16).astype(np.float16)
            new.q[row] += change
            sums[row] = sums.get(row, 0) + (lane + 1) * (new.q[row] - old.q[row]).astype(np.float16).astype(float)
            weight[row] = weight.get(row, 0) + lane + 1
        sent += list(lm.changes(old, new, lane + 1.0, lane))
    assert all(b.column("k")[0].as_py() == 1 for b in sent)  # nothing but what changed
    first = [lm.merged(pa.Table.from_batches(sent[i:i + 32])) for i in range(0, len(sent), 32)]
    out = lm.merged(pa.concat_tables(first))
    rows, got = (np.frombuffer(out.column(c)[0].as_py(), t) for c, t in (("rows", np.int32), ("change", np.float32)))
    assert rows.tolist() == sorted(sums)
    assert np.allclose(got.reshape(len(rows), 16), [sums[r] / weight[r] for r in rows], atol=1e-5)


def test_training_leaves_no_shuffle_files_or_broadcasts_behind(spark, make):
    def blocks():
        env = spark._jvm.org.apache.spark.SparkEnv.get()
        return {b for b in env.blockManager().diskBlockManager().getAllBlocks().mkString("\n").split("\n") if b.startswith("shuffle")}

    train = make([(i, f"a b{i % 7} c{i % 5} d") for i in range(200)])
    w, _ = lm.frequent(lm.word_counts(train), None, 1 << 10)
    before, sent = blocks(), set(os.listdir(spark.sparkContext._temp_dir))
    lm.train(lm.numbers(train, w), w, task_tokens=400)
    for _ in range(100):  # they are removed in the background
        if blocks() <= before:
            break
        time.sleep(0.1)
    assert blocks() <= before and set(os.listdir(spark.sparkContext._temp_dir)) <= sent


def test_words_of_a_batch_are_the_tokens_of_every_text():
    rng, letters = random.Random(4), list(" \t\n\x0b\x0c\r\x1c\x1f\x85\xa0 \x00aAbBÄſKİ0-")
    for size in [0, 1, *[rng.randrange(1, 8) for _ in range(200)]]:
        texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 14))) for _ in range(size)]
        ws, number, lengths = lm.words_of(pa.array(["left out", *texts], pa.string())[1:])
        want = [tokens(t) for t in texts]
        assert len(set(ws)) == len(ws) and [ws[i] for i in number] == sum(want, []) and lengths.tolist() == [len(x) for x in want]


def _one_step(m, share, a, b, out, n, seed):
    """The only step of one batch and one class, every noise draw by itself, in doubles."""
    rng = np.random.default_rng(seed)
    rng.permutation(len(out)), rng.permutation(1)
    x = np.searchsorted(np.cumsum(share), rng.random(lm.NOISE), "right")
    r, q, c, bias = (p.astype(float) for p in (m.r, m.q, m.c, m.bias))
    ctx, offset, u = c[0] * r[a] + c[1] * r[b], np.log(lm.NOISE * share), n / n.sum()
    gain = -u / (1 + np.exp((ctx * q[out]).sum(1) + bias[out] - offset[out]))
    lose = u[:, None] / (1 + np.exp(-(ctx @ q[x].T + bias[x] - offset[x])))
    d_ctx = gain[:, None] * q[out] + lose @ q[x]
    grads = [np.zeros_like(p) for p in (r, q, c, bias)]
    for rows, d in ((a, d_ctx * c[0]), (b, d_ctx * c[1])):
        np.add.at(grads[0], rows, d)
    for rows, d in ((out, gain[:, None] * ctx), (x, lose.T @ ctx)):
        np.add.at(grads[1], rows, d)
    grads[2] += np.stack([(d_ctx * r[a]).sum(0), (d_ctx * r[b]).sum(0)])
    for rows, d in ((out, gain), (x, lose.sum(0))):
        np.add.at(grads[3], rows, d)
    return [p - lm.RATE * g / np.sqrt(lm.DAMP + g * g) for p, g in zip((r, q, c, bias), grads)]


@pytest.mark.parametrize("size", [8, 240])  # all outputs in one product, those drawn only
@pytest.mark.parametrize("weighted", [False, True])
def test_noise_drawn_again_is_computed_once_and_counts_as_often(monkeypatch, size, weighted):
    rng = np.random.default_rng(size)
    counts = np.r_[300, rng.integers(5, 900, size)]
    w = lm.Words(np.arange(size + 1, dtype=np.uint64), counts, np.arange(size + 1).astype(np.int32), size, int(counts.sum()) + 90, size + 50)
    m = lm.Model.start(w)
    a, b, out = rng.integers(0, size + 3, 700), rng.integers(0, size + 3, 700), rng.integers(0, size + 2, 700)
    n, widths, exp = rng.integers(1, 9, 700) * 1.0 if weighted else np.ones(700), [], np.exp

    def noted(x, **to):
        widths.extend(x.shape[1:])
        return exp(x, **to)
    monkeypatch.setattr(np, "exp", noted)
    got = lm.train_share(m, w.unigram(), a, b, out, n, 9)
    assert len(widths) == 1 and widths[0] < lm.NOISE
    for p, want in zip((got.r, got.q, got.c, got.bias), _one_step(m, w.unigram(), a, b, out, n, 9)):
        assert np.allclose(p, want, atol=2e-5)
