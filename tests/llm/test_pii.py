"""Patterns against the plain expressions, gradients, and held-out spans."""

import random
import re

import numpy as np
import pytest

from daybook.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(t):
    out = []
    for kind, expr in PLAIN.items():
        for m in re.finditer(expr, t):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) \
                    or kind == "card" and not (16 <= len(d) <= 19 and pii.luhn(d)) or kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_patterns_equal_the_plain_expressions(texts):
    rng = random.Random(3)
    fuzz = ["".join(rng.choice("ab1.@+ -()29%é") for _ in range(60)) for _ in range(5000)]
    for t in [*texts.values(), *fuzz]:
        assert pii.pattern_spans(t) == plain_spans(t)
    pii.pattern_spans("1" * 200000 + "a" * 200000 + "@")  # no quadratic search


def test_gradients():
    rng = np.random.default_rng(1)
    p, x, y = pii.new_model(), rng.integers(0, pii.N_CHARS, (7, 3)), np.zeros((7, 3), int)
    y[2], y[3] = 1, 2
    _, grad = pii.loss_and_gradient(x, y, p)
    for k, at in (("out", (3, 1)), ("out_b", (2,)), ("trans", (0, 1)), ("x", (1, x[3, 1], 5)), ("h", (0, 2, 7)), ("c", (1, 0, 9))):
        was = p[k][at]
        p[k][at] = was + 1e-5
        up = pii.loss_and_gradient(x, y, p)[0]
        p[k][at] = was - 1e-5
        down = pii.loss_and_gradient(x, y, p)[0]
        p[k][at] = was
        assert abs((up - down) / 2e-5 - grad[k][at]) < 1e-5


@pytest.fixture(scope="module")
def trained():
    rng = random.Random(6)
    words = "the of and a long plain word with some others between them".split()
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        while not pii.luhn(c := "4" + num(15)):
            pass
        return c

    def text():
        datum = rng.choice([f"{rng.choice(words)}.{num(2)}@mail{num(1)}.example.com", f"{rng.randrange(256)}.{num(2)}.{num(1)}.{num(2)}",
                            card(), f"+1 ({num(3)}) 555-{num(4)}"])
        return f"{some(rng.randrange(5, 40))} {datum} {some(rng.randrange(5, 40))}"
    made = [text() for _ in range(500)]
    return pii.fit(made[:350]), made[350:]


def test_held_out_spans_are_found(trained):
    model, held = trained
    hit = sum(bool({x[1:] for x in base} & {(s, e) for _, s, e in got})
              for base, got in zip(map(pii.pattern_spans, held), pii.model_spans(held, model)))
    assert hit / len(held) > 0.85


def test_pattern_spans_stay_and_added_ones_pass_their_check(trained):
    model, held = trained
    probe = held + ["the server 10[.]0[.]3[.]7 was down", "the word 2021-03-04 and 24be64439e3e49cf46b2d7c90f3602a3 a", "plain words only", ""]
    for t, (base, spans) in zip(probe, pii.all_spans(probe, model)):
        assert base == pii.pattern_spans(t) and set(base) <= set(spans)
        for kind, s, e in set(spans) - set(base):
            assert pii.plausible(kind, t[s:e]) and not any(s < b and a < e for _, a, b in base)
    assert [s for _, s in pii.all_spans(probe, model)][-2:] == [[], []]


def test_window_edges_do_not_matter(trained):
    model, _ = trained
    datum = "mary.12@mail3.example.com"
    for lead in range(0, 140, 9):
        t = "a" * 3 + " word" * (lead // 5) + "x" * (lead % 5) + " " + datum + " and the others"
        at = t.index(datum)
        assert any(s <= at < e and e == at + len(datum) for s, e in (pii.trimmed(t, s, e) for _, s, e in pii.model_spans([t], model)[0]))


def test_redaction():
    t = "a x@y.zz b 1.2.3.4"
    assert pii.redacted(t, pii.pattern_spans(t)) == "a <EMAIL> b <IP>"
    assert pii.redacted("abcdef", [("card", 1, 4), ("phone", 2, 5)]) == "a<CARD>f"


def test_every_span_and_number_of_a_text_teaches():
    text = " and then ".join([*(f"user{i}@example.com" for i in range(6)), "10.20.30.40", "4111 1111 1111 1111", "+1 202 555 0147",
                              *("a plain word " * 9 + f"section {c}{c}" for c in "abc"), "a plain word " * 9 + "in 1999"])
    kinds = {k for k, _, _ in pii.pattern_spans(text)}
    _, y = pii.training_windows([text])
    taught = {pii.KINDS[(int(v) - 1) // 2] for v in np.unique(y) if v > 0}
    assert kinds == set(pii.KINDS) and taught == kinds
    x, y = pii.training_windows([text])
    last = pii.codes("in 1999")
    assert any((np.lib.stride_tricks.sliding_window_view(row, len(last)) == last).all(1).any() for row in x)


def test_every_trained_form_is_found_in_held_out_texts(trained):
    model, held = trained
    rng, found = np.random.default_rng(17), {}
    plain = {"email": "mary.lee7@mail3.example.com", "ip": "1.2.3.4", "card": "4111111111111111", "phone": "+1 (202) 555-0147"}
    for kind, forms in pii.FORMS.items():
        for name, form in forms.items():
            texts, want = [], []
            for t in held[:60]:
                words = [w for w in t.split() if not re.search("[0-9@]", w)]
                datum = form(pii.redrawn(kind, plain[kind], rng))
                lead = " ".join(words[:8]) + " "
                texts.append(f"{lead}{datum} {' '.join(words[8:])}")
                want.append((kind, len(lead), len(lead) + len(datum)))
            found[name] = sum(w in spans for w, (_, spans) in zip(want, pii.all_spans(texts, model))) / len(want)
    assert min(found.values()) >= 0.8 and sum(found.values()) / len(found) >= 0.9, found
    clean = [" ".join(w for w in t.split() if not re.search("[0-9@]", w)) for t in held]
    others = [f"{c[:30]} {pii.other_number(rng)} {c[30:]}" for c in clean]
    assert sum(bool(spans) for _, spans in pii.all_spans(others, model)) <= 0.05 * len(others)


def test_a_model_learned_on_a_table_is_the_same_each_time(make, monkeypatch):
    monkeypatch.setattr(pii, "BATCH", 4)  # a short training; the module travels with its values
    rows = [(i, f"write to user{i}.{i % 7}@mail{i % 5}.example.com or call +1 (20{i % 10}) 555-01{i % 90 + 10} in 20{i % 30 + 10}") for i in range(40)]
    a, b = pii.learn(make(rows)), pii.learn(make(rows[::-1]))
    assert a.keys() == pii.new_model().keys() and all((a[k] == b[k]).all() and a[k].shape == pii.new_model()[k].shape for k in a)
    assert pii.learn(make([(1, "no number"), (2, None)])) is None and pii.learn(make([(1, "in 1999")])) is None
