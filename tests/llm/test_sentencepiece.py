"""The streaming Viterbi search against the library, and the round trip."""

import random

import numpy as np
import pytest

from daybook.llm import sentencepiece_codec as codec

sp = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def pieces():
    return codec.Pieces.load(codec.MODEL)


@pytest.fixture(scope="module")
def strings(texts):
    rng = random.Random(4)
    return list(texts.values())[:80] + [
        "", " ", "   ", "a  b   c", "x\n\n y", "日本語 梦 🎉 emoji", "a" * 3000, "ab" * 500 + "  " * 40, "é́ñ", "\t\tdef f():\n        return 1\n",
        "".join(rng.choice("etaoin shrdlu\n.,") for _ in range(5000)), "".join(rng.choice("etaoinshrdlu") for _ in range(4000))]


def test_bpe_ids_equal_the_library(pieces, strings):
    lib, known = sp.SentencePieceProcessor(model_file=codec.MODEL), codec.Stretches(pieces)
    for s in strings:
        assert np.frombuffer(codec.encode_text(s, known), np.int32).tolist() == lib.encode(s)


def test_unigram_ids_equal_the_library(strings):
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    with open(codec.MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = codec.UNIGRAM
    rng = random.Random(9)
    for p in m.pieces:  # scores whose sums are exact in single precision
        if p.type == 1:
            p.score = -(5 + rng.randrange(1 << 10) / (1 << 7)) if len(p.piece) > 1 else -(8 + rng.randrange(1 << 10) / (1 << 7))
    lib = sp.SentencePieceProcessor(model_proto=m.SerializeToString())
    pieces = codec.Pieces([(p.piece, p.score, p.type) for p in m.pieces], codec.UNIGRAM)
    for s in strings:
        got = codec.search(("▁" + s.replace(" ", "▁")) if s else "", pieces)
        want = lib.encode(s)
        total = lambda ids: sum(pieces.scores[i] for i in ids)
        assert got == want or total(got) == total(want) and len(s) > 200


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_feeding_in_chunks_changes_nothing_and_holds_little(pieces, step):
    rng = random.Random(step)
    text = "".join(rng.choice("etaoinshrdlu▁") for _ in range(3000))
    v, out, most = codec.Viterbi(pieces), [], 0
    for at in range(0, len(text), step):
        out += v.feed(text[at:at + step])
        most = max(most, v.waiting)
    out += v.finish()
    assert out == codec.search(text, pieces) and most <= step + 3 * pieces.longest


@pytest.mark.parametrize("kind", [codec.BPE, codec.UNIGRAM])
def test_the_search_over_one_window_equals_the_streaming_one(pieces, kind):
    rng = random.Random(kind)
    own = codec.Pieces([(p, -rng.randrange(1 << 12) / (1 << 7), t) for p, _, t in pieces.entries], kind) if kind == codec.UNIGRAM else pieces
    for _ in range(400):
        text = "".join(rng.choice("etaoinshrdlu▁▁.,%é日\n") for _ in range(rng.randrange(1, 64)))
        v = codec.Viterbi(own)
        assert v.feed(text) + v.finish() == codec.search(text, own)


def test_both_directions_in_one_pass(make, pieces, strings):
    lib = sp.SentencePieceProcessor(model_file=codec.MODEL)
    rows = [(i, s) for i, s in enumerate(strings)] + [(-1, None), (0, strings[0])]
    out = codec.round_trip(make(rows), pieces)
    assert out.columns == ["doc_id", "ids", "round_trip"]
    got = out.collect()
    assert len(got) == len(rows) and all(r["round_trip"] for r in got)
    assert {r["doc_id"]: r["ids"] for r in got} == {i: lib.encode(s or "") for i, s in rows}


def test_round_trip_on_a_table(make, pieces, strings):
    rows = [(i, s) for i, s in enumerate(strings)]
    back = codec.decode(codec.encode(make(rows), pieces), pieces).collect()
    assert all(r["decoded"] == r["text"] for r in back)
    assert codec.decode(codec.encode(make([(1, None)]), pieces), pieces).first()["decoded"] == ""
