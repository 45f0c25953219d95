"""Personal data: fixed patterns, and a character BiLSTM with a CRF on top.

The patterns (email, IP, card, phone, each with its check) always give their
spans.  A bidirectional LSTM over characters with CRF transitions, trained
here in numpy, adds spans in forms that the patterns miss, such as phone
numbers without a plus or addresses with bracketed dots.

Training takes at most ``SAMPLE_DOCS`` documents that hold a digit or '@'
(chosen by hash of doc_id): the pattern spans are their labels, and every
labelled span is also redrawn and written in every other form of its kind
(``FORMS``).  Numbers of other kinds stay unlabelled, stand in the same places,
and teach what is no personal data.  One task trains on at most
``SAMPLE_WINDOWS`` windows, half of them without a span.

Every text is covered by windows of ``WINDOW`` characters, ``STRIDE`` apart.
Where windows overlap, their scores are averaged, the middle of a window
counting most, and one CRF decoding runs over each whole run of windows, so a
span cut by a window's edge comes out whole.  A span has to hold a digit or
'@'; windows without either can have none and are not computed.  A decoded
span is added if its numbers pass the check of its kind (``plausible``) and it
overlaps no pattern span.

Defined cases: null text counts as empty, with no spans; rows repeated are
read each; a table without training documents gets pattern spans only; extra
columns pass; a column that clashes with a result column is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import give_back, whole_text
from daybook.llm.near_dedup import small_batches

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_WINDOWS, WINDOW, STRIDE = 1000, 8000, 64, 32
HIDDEN, EPOCHS, BATCH, RATE = 16, 5, 128, 0.02
TRIGGER, RICH = "[0-9@]", r"@|[0-9][0-9 .()-]{6,}[0-9]"  # the second: may well hold a span
_TRIGGER_RUN = re.compile("[0-9@][0-9@.,:+-]*")  # one number or sign
_TRIGGER = re.compile(TRIGGER)

# ---- the fixed patterns

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match cannot begin inside a run of digits whose start does not match
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _is_ip(s: str) -> bool:
    parts = [p.lstrip("0") for p in s.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the '@' signs in turn, each with the local part before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            free = m.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    if not _TRIGGER.search(text):
        return []
    out = [("email", *s) for s in emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _is_ip(m[0])]
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def plausible(kind: str, s: str) -> bool:
    """The numbers' own check of a span that the model adds; its form is the
    model's affair."""
    d = _digits(s)
    if kind == "email":
        return 0 < s.find("@") < len(s) - 1
    if kind == "ip":
        parts = re.findall("[0-9]+", s)
        return len(parts) == 4 and _is_ip(".".join(parts))
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return 8 <= len(d) <= 15


# ---- the model

_CHARS = {c: i + 2 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789@.+-()[]_%, \n/:#\"'=")}
N_CHARS, N_TAGS = len(_CHARS) + 2, 1 + 2 * len(KINDS)  # 0: outside the text, 1: any other
_CODES = np.ones(128, np.int16)
for _c, _i in _CHARS.items():
    _CODES[ord(_c)] = _i
    _CODES[ord(_c.upper())] = _i


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CODES[np.minimum(points, 127)], 1)


def _allowed() -> np.ndarray:
    """0 where tag j may follow tag i, else a large negative number: the inside
    of a kind follows only its beginning or inside."""
    m = np.zeros((N_TAGS, N_TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        m[:, inside] = -1e4
        m[inside - 1, inside] = m[inside, inside] = 0
    return m


_ALLOWED = _allowed()
_START = np.where(np.arange(N_TAGS) % 2 == 0, -1e4, 0.0)  # a sequence starts outside or with a beginning
_START[0] = 0


def new_model(seed: int = 2) -> dict[str, np.ndarray]:
    """Parameters; x, h and c hold both directions, forward first."""
    rng, h = np.random.default_rng(seed), HIDDEN
    bias = np.zeros((2, 1, 4 * h))
    bias[:, :, h:2 * h] = 1
    return {"out": rng.normal(0, 0.1, (2 * h, N_TAGS)), "out_b": np.zeros(N_TAGS), "trans": np.zeros((N_TAGS, N_TAGS)),
            "x": rng.normal(0, 0.3, (2, N_CHARS, 4 * h)), "h": rng.normal(0, h ** -0.5, (2, h, 4 * h)), "c": bias}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lstm(x: np.ndarray, p: dict) -> tuple[np.ndarray, list]:
    """Outputs (length, 2, batch, hidden) of both directions over codes
    (length, batch), the backward one in reading order of its own, and what
    the way back needs."""
    h = c = np.zeros((2, x.shape[1], HIDDEN), p["h"].dtype)
    outs, tape = np.empty((len(x), *h.shape), h.dtype), []
    given = np.stack([p["x"][0][x], p["x"][1][x[::-1]]], axis=1) + p["c"]
    for t in range(len(x)):
        z = given[t] + h @ p["h"]
        s = _sigmoid(z[..., :3 * HIDDEN])
        i, f, o = s[..., :HIDDEN], s[..., HIDDEN:2 * HIDDEN], s[..., 2 * HIDDEN:]
        g = np.tanh(z[..., 3 * HIDDEN:])
        c_next = f * c + i * g
        tanh_c = np.tanh(c_next)
        tape.append((h, c, i, f, o, g, tanh_c))
        h, c = o * tanh_c, c_next
        outs[t] = h
    return outs, tape


def _lstm_back(x: np.ndarray, tape: list, d_out: np.ndarray, p: dict, grad: dict) -> None:
    dh = dc = np.zeros((2, x.shape[1], HIDDEN), p["h"].dtype)
    dzs = np.empty((len(x), 2, x.shape[1], 4 * HIDDEN), p["h"].dtype)
    back = p["h"].transpose(0, 2, 1)
    for t in range(len(x) - 1, -1, -1):
        h, c, i, f, o, g, tanh_c = tape[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - tanh_c ** 2)
        dz = dzs[t]
        dz[..., :HIDDEN] = dc * g * i * (1 - i)
        dz[..., HIDDEN:2 * HIDDEN] = dc * c * f * (1 - f)
        dz[..., 2 * HIDDEN:3 * HIDDEN] = dh * tanh_c * o * (1 - o)
        dz[..., 3 * HIDDEN:] = dc * i * (1 - g * g)
        grad["h"] += h.transpose(0, 2, 1) @ dz
        dh, dc = dz @ back, dc * f
    for d, order in enumerate((x, x[::-1])):
        flat = dzs[:, d].reshape(-1, 4 * HIDDEN)
        grad["c"][d, 0] += flat.sum(0)
        one_hot = np.zeros((N_CHARS, flat.shape[0]), flat.dtype)
        one_hot[order.ravel(), np.arange(flat.shape[0])] = 1
        grad["x"][d] += one_hot @ flat


def _both(outs: np.ndarray) -> np.ndarray:
    return np.concatenate([outs[:, 0], outs[::-1, 1]], axis=2)


def emissions(x: np.ndarray, p: dict) -> np.ndarray:
    """Tag scores (length, batch, tags) of codes (length, batch)."""
    return _both(_lstm(x, p)[0]) @ p["out"] + p["out_b"]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis, keepdims=True))).squeeze(axis)


def loss_and_gradient(x: np.ndarray, y: np.ndarray, p: dict) -> tuple[float, dict]:
    """Mean negative log likelihood of tags y (length, batch) under the CRF."""
    length, batch = x.shape
    outs, tape = _lstm(x, p)
    both = _both(outs)
    e = both @ p["out"] + p["out_b"]
    trans = p["trans"] + _ALLOWED.astype(p["trans"].dtype)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0] + _START.astype(e.dtype)
    for t in range(1, length):
        alpha[t] = e[t] + _log_sum(alpha[t - 1][:, :, None] + trans, 1)
    for t in range(length - 2, -1, -1):
        beta[t] = _log_sum(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _log_sum(alpha[-1], 1)
    rows = np.arange(batch)
    d_e = np.exp(alpha + beta - z[None, :, None])
    d_trans = np.zeros_like(p["trans"])
    gold = e[0][rows, y[0]].copy()
    for t in range(1, length):
        pair = np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :] - z[:, None, None])
        d_trans += pair.sum(0)
        np.add.at(d_trans, (y[t - 1], y[t]), -1)
        gold += e[t][rows, y[t]] + trans[y[t - 1], y[t]]
    for t in range(length):
        d_e[t][rows, y[t]] -= 1
    d_e /= batch
    flat = d_e.reshape(-1, N_TAGS)
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    grad["trans"] = d_trans / batch
    grad["out"] = both.reshape(-1, 2 * HIDDEN).T @ flat
    grad["out_b"] = flat.sum(0)
    d_both = d_e @ p["out"].T
    _lstm_back(x, tape, np.stack([d_both[:, :, :HIDDEN], d_both[::-1, :, HIDDEN:]], axis=1), p, grad)
    return float((z - gold).mean()), grad


def viterbi(e: np.ndarray, p: dict) -> np.ndarray:
    """Best tags of scores (length, tags)."""
    trans = (p["trans"] + _ALLOWED).T.copy()  # to, from
    best, back = e[0] + _START, np.empty((len(e), N_TAGS), np.int8)
    span = np.arange(N_TAGS)
    for t in range(1, len(e)):
        s = trans + best
        back[t] = s.argmax(1)
        best = s[span, back[t]] + e[t]
    tags = np.empty(len(e), np.int8)
    tags[-1] = best.argmax()
    for t in range(len(e) - 1, 0, -1):
        tags[t - 1] = back[t][tags[t]]
    return tags


# ---- training rows

def redrawn(kind: str, s: str, rng: np.random.Generator) -> str:
    """A datum of the same kind with other digits (in an address, another
    local part of one to three parts) that passes the same check."""
    if kind == "email":
        parts = ["".join(chr(97 + int(c)) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(rng.integers(1, 4))]
        number = str(rng.integers(0, 10 ** int(rng.integers(1, 4)))) if rng.random() < 0.5 else ""
        return "._-"[int(rng.integers(3))].join(parts) + number + "@" + s.partition("@")[2]
    if kind == "ip":
        return ".".join(map(str, rng.integers(1, 256, 4)))
    if kind == "phone":
        return s[:2] + "".join(str(rng.integers(10)) if c.isdigit() else c for c in s[2:])
    d = "4" + "".join(map(str, rng.integers(0, 10, 14)))
    return d + next(c for c in "0123456789" if luhn(d + c))


def _in_fours(d: str, mark: str) -> str:
    return mark.join(d[i:i + 4] for i in range(0, len(d), 4))


#: How each kind is also written; the model is taught all of them.
FORMS = {
    "email": {"x @ y": lambda s: s.replace("@", " @ "), "x@ y": lambda s: s.replace("@", "@ "),
              "x@y[.]z": lambda s: s.partition("@")[0] + "@" + s.partition("@")[2].replace(".", "[.]")},
    "ip": {"1[.]2[.]3[.]4": lambda s: s.replace(".", "[.]"), "1(.)2(.)3(.)4": lambda s: s.replace(".", "(.)")},
    "card": {"dddd.dddd": lambda s: _in_fours(_digits(s), "."), "dddd/dddd": lambda s: _in_fours(_digits(s), "/"),
             "dddd-dddd": lambda s: _in_fours(_digits(s), "-"), "dddd dddd": lambda s: _in_fours(_digits(s), " ")},
    "phone": {"(ddd) ddd-dddd": lambda s: "({}) {}-{}".format(*_ten(s)), "ddd-ddd-dddd": lambda s: "{}-{}-{}".format(*_ten(s)),
              "ddd.ddd.dddd": lambda s: "{}.{}.{}".format(*_ten(s)), "0ddd ddd dddd": lambda s: "0{} {} {}".format(*_ten(s))},
}


def _ten(s: str) -> tuple[str, str, str]:
    d = _digits(s)[-10:].rjust(10, "5")
    return d[:3], d[3:6], d[6:]


def other_number(rng: np.random.Generator) -> str:
    """A number that is no personal data."""
    r = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    return (f"20{r(2)}-{r(2)}-{r(2)}", f"{r(2)}.{r(1)}.{r(1)}", f"{r(3)},{r(3)}", r(int(rng.integers(1, 8))), f"{r(2)}:{r(2)}",
            f"{r(1)}.{r(3)}", f"no. {r(6)}", hashlib.md5(r(9).encode()).hexdigest())[int(rng.integers(8))]


def _window(text: str, spans: list[tuple[str, int, int]], about: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of WINDOW characters that hold the place ``about``."""
    at = max(0, min(about - int(rng.integers(8, WINDOW - 8)), len(text) - WINDOW))
    tags = np.zeros(len(text), np.int8)
    for kind, s, e in spans:
        if not tags[s:e].any():
            k = 1 + 2 * KINDS.index(kind)
            tags[s:e], tags[s] = k + 1, k
    x, y = np.zeros(WINDOW, np.int16), np.zeros(WINDOW, np.int8)
    cut_x, cut_y = codes(text[at:at + WINDOW]), tags[at:at + WINDOW].copy()
    if len(cut_y) and cut_y[0] and cut_y[0] % 2 == 0:  # a span cut at the edge begins there
        cut_y[0] -= 1
    x[:len(cut_x)], y[:len(cut_y)] = cut_x, cut_y
    return x, y


def text_windows(text: str, seed: int = 3, times: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows around every span of a text, as it stands and redrawn ``times``
    in every form of its kind, and around every number and '@' sign; numbers that are no
    personal data also stand in the same places."""
    rng = np.random.default_rng([seed, len(text), *text[:64].encode()])
    spans, out = pattern_spans(text), []
    for kind, s, e in spans:
        lo, hi = max(0, s - WINDOW), min(len(text), e + WINDOW)
        near = [(k, a - lo, b - lo) for k, a, b in spans if a >= lo and b <= hi]
        out.append(_window(text[lo:hi], near, s - lo, rng))
        for form in [f for f in FORMS[kind].values() for _ in range(times)]:
            new = form(redrawn(kind, text[s:e], rng))
            out.append(_window(text[lo:s] + new + text[e:hi], [(kind, s - lo, s - lo + len(new))], s - lo, rng))
        for _ in range(times):
            out.append(_window(text[lo:s] + other_number(rng) + text[e:hi], [], s - lo, rng))
    for m in _TRIGGER_RUN.finditer(text):
        lo = max(0, m.start() - WINDOW)
        cut = text[lo:m.start() + WINDOW]
        out.append(_window(cut, [(k, max(a, lo) - lo, min(b, lo + len(cut)) - lo) for k, a, b in spans if b > lo and a < lo + len(cut)], m.start() - lo, rng))
        before = text[max(0, m.start() - WINDOW):m.start()].rsplit(" ", 1)[0]
        if not _TRIGGER.search(before):
            out.append(_window(f"{before} {other_number(rng)} {before}", [], len(before) + 1, rng))
    return out


def training_windows(texts: list[str], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags (windows, WINDOW) of the texts, as many without any span
    as with one, and at most ``SAMPLE_WINDOWS``, chosen by hash."""
    return balanced([w for t in texts for w in text_windows(t, seed)], seed)


def balanced(windows: list[tuple[np.ndarray, np.ndarray]], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    x = np.array([w[0] for w in windows], np.int16).reshape(-1, WINDOW)
    y = np.array([w[1] for w in windows], np.int8).reshape(-1, WINDOW)
    order = np.argsort([hashlib.blake2b(a.tobytes() + bytes([seed]), digest_size=8).digest() for a in x]) if len(x) else np.empty(0, int)
    x, y = x[order], y[order]
    held = y.any(1)
    with_span, without = np.flatnonzero(held), np.flatnonzero(~held)
    pick = np.sort(np.r_[with_span[:SAMPLE_WINDOWS // 2], without[:min(SAMPLE_WINDOWS // 2, max(len(with_span), 1000))]])
    return x[pick], y[pick]


def fit(texts: list[str], seed: int = 2) -> dict[str, np.ndarray] | None:
    """The model trained on texts; None without anything to learn from."""
    return train(*training_windows(texts), seed)


def train(x: np.ndarray, y: np.ndarray, seed: int = 2) -> dict[str, np.ndarray] | None:
    """The model trained on windows of codes and tags."""
    if not y.any():
        return None
    p = {k: v.astype(np.float32) for k, v in new_model(seed).items()}
    rng, step = np.random.default_rng(seed), 0
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    rounds = max(EPOCHS, -(-300 * BATCH // len(x)))  # few windows are seen more often: 300 steps at least
    for turn in range(rounds):
        order = rng.permutation(len(x))
        for at in range(0, len(order), BATCH):
            i, step = order[at:at + BATCH], step + 1
            _, grad = loss_and_gradient(x[i].T.astype(np.int64), y[i].T.astype(np.int64), p)
            rate = RATE * (1.0 if turn < rounds / 2 else 0.3)
            for k, g in grad.items():  # Adam
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                p[k] = p[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)
    return p


# ---- spans of whole texts

_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(float)


def _runs(text: str) -> list[tuple[int, int]]:
    """(first, last) of runs of neighbouring windows that hold a trigger."""
    runs: list[list[int]] = []
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) if len(text) > WINDOW else 0
    for m in _TRIGGER.finditer(text):
        hi = min(m.start() // STRIDE, last)
        lo = max(0, -(-(m.start() - WINDOW + 1) // STRIDE))
        if runs and lo <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi])
    return [(a, b) for a, b in runs]


def model_spans(texts: list[str], p: dict) -> list[list[tuple[str, int, int]]]:
    """Spans that the model decodes in each text, before the checks."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    jobs = [(i, a, b) for i, t in enumerate(texts) for a, b in _runs(t)]
    for at in range(0, len(jobs), 64):
        part, starts, rows = jobs[at:at + 64], [], []
        coded = {i: codes(texts[i]) for i in {j[0] for j in part}}
        for i, a, b in part:
            starts.append(len(rows))
            for k in range(a, b + 1):
                x = np.zeros(WINDOW, np.int64)
                c = coded[i][k * STRIDE:k * STRIDE + WINDOW]
                x[:len(c)] = c
                rows.append(x)
        scores = np.concatenate([emissions(np.array(rows[r:r + 512]).T, p).transpose(1, 0, 2) for r in range(0, len(rows), 512)])
        for (i, a, b), first in zip(part, starts):
            origin = a * STRIDE
            length = min((b - a) * STRIDE + WINDOW, len(texts[i]) - origin)
            total, weight = np.zeros((length, N_TAGS)), np.zeros(length)
            for k in range(a, b + 1):
                lo = (k - a) * STRIDE
                n = min(WINDOW, length - lo)
                total[lo:lo + n] += scores[first + k - a][:n] * _WEIGHT[:n, None]
                weight[lo:lo + n] += _WEIGHT[:n]
            tags = viterbi(total / weight[:, None], p)
            begins = np.flatnonzero((tags > 0) & (tags % 2 == 1))
            for s in begins:
                e = s + 1
                while e < length and tags[e] == tags[s] + 1:
                    e += 1
                out[i].append((KINDS[tags[s] // 2], origin + int(s), origin + int(e)))
    return out


def trimmed(text: str, s: int, e: int) -> tuple[int, int]:
    while s < e and text[s] in " \n.,;:-":
        s += 1
    while e > s and text[e - 1] in " \n.,;:-(":
        e -= 1
    return s, e


def _single(text: str, kind: str, s: int, e: int) -> Iterator[tuple[str, int, int]]:
    """A decoded span; one of several cards in a row as each of them."""
    if kind != "card" or len(_digits(text[s:e])) <= 19:
        yield kind, s, e
        return
    for m in re.finditer(r"[0-9]+", text[s:e]):
        yield kind, s + m.start(), s + m.end()


def all_spans(texts: list[str], p: dict | None) -> list[tuple[list, list]]:
    """For each text its pattern spans, and all spans, both by kind, then start."""
    added = model_spans(texts, p) if p else [[] for _ in texts]
    out = []
    for text, extra in zip(texts, added):
        base = pattern_spans(text)
        taken = [(s, e) for _, s, e in base]
        spans = list(base)
        for kind, s, e in (x for found in extra for x in _single(text, *found)):
            s, e = trimmed(text, s, e)
            if plausible(kind, text[s:e]) and not any(s < b and a < e for a, b in taken):
                spans.append((kind, s, e))
                taken.append((s, e))
        out.append((base, sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1]))))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans, the whole stretch by the first."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s < at:  # overlaps the one before
            at = max(at, e)
            continue
        out += [text[at:s], f"<{kind.upper()}>"]
        at = e
    return "".join([*out, text[at:]])


# ---- on tables

def learn(docs: DataFrame, sample: int = SAMPLE_DOCS) -> dict[str, np.ndarray] | None:
    """The model from at most ``sample`` documents: half of them with '@' or a
    long number, half with any digit, chosen by hash.  Windows of codes are cut
    where the documents are, one task trains on at most ``SAMPLE_WINDOWS`` of
    them (192 bytes each), and the parameters, some 60 kB, come back."""
    rows = docs.select(F.xxhash64(F.col("doc_id").cast("string")).alias("_order"), whole_text().alias("text")).where(F.col("text").rlike(TRIGGER))
    rows = rows.withColumn("_rich", F.col("text").rlike(RICH))
    counted = {r["_rich"]: r["count"] for r in rows.groupBy("_rich").count().collect()}
    if not counted:
        return None

    def part(rich: bool, n: int) -> DataFrame:
        # first a share by hash that holds about twice as many, then the first n
        share = F.pmod(F.col("_order"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 2 * n / max(1, counted.get(rich, 0)))) + 1
        return rows.where((F.col("_rich") == rich) & share).orderBy("_order", F.xxhash64("text")).limit(n).select("text")

    rich = min(counted.get(True, 0), max(sample // 2, sample - counted.get(False, 0)))
    chosen = part(True, rich).unionByName(part(False, sample - rich)) if rich < sample else part(True, rich)

    def cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("text"):
                found = text_windows(t.as_py())
                yield pa.RecordBatch.from_pydict({"x": pa.array([w[0].tobytes() for w in found], pa.binary()),
                                                  "y": pa.array([w[1].tobytes() for w in found], pa.binary())})

    def train_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(np.frombuffer(a.as_buffer(), np.int16), np.frombuffer(b.as_buffer(), np.int8))
                 for batch in batches for a, b in zip(batch.column("x"), batch.column("y"))]
        model = train(*balanced(found)) or {}
        del found
        give_back()
        yield pa.RecordBatch.from_pydict({"name": pa.array(list(model), pa.string()),
                                          "shape": pa.array([list(v.shape) for v in model.values()], pa.list_(pa.int32())),
                                          "data": pa.array([v.astype(np.float32).tobytes() for v in model.values()], pa.binary())})

    trained = (chosen.mapInArrow(cut_windows, "x binary, y binary").repartition(1)
               .mapInArrow(train_one, "name string, shape array<int>, data binary").collect())
    return {r["name"]: np.frombuffer(r["data"], np.float32).astype(float).reshape(r["shape"]) for r in trained} or None


def find(docs: DataFrame, model: dict[str, np.ndarray] | None) -> DataFrame:
    """``docs`` with base_spans, spans (array of kind, start, end) and redacted."""
    base = docs.drop("base_spans", "spans", "redacted")
    names = base.columns
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        as_rows = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
        for batch in batches:
            for part in small_batches(batch):
                texts = [t.as_py() or "" for t in part.column("text")]
                found = all_spans(texts, model)
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in names} | {
                    "base_spans": pa.array([as_rows(b) for b, _ in found], kind),
                    "spans": pa.array([as_rows(a) for _, a in found], kind),
                    "redacted": pa.array([redacted(t, a) for t, (_, a) in zip(texts, found)], pa.string())})
        give_back()
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("base_spans", T.ArrayType(span)),
                                              T.StructField("spans", T.ArrayType(span)), T.StructField("redacted", T.StringType())]))
