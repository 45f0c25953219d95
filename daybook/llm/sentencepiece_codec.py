"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text (with a space before it and spaces as U+2581, as the model asks) is
walked once.  Every position keeps its best last piece and a pointer back, in
a window as long as the longest piece; only positions in the window can still
be extended.  Whenever all their paths back meet in one boundary, the ids
before it are committed and forgotten, so memory does not grow with the text.

Which last piece is best depends on the model's kind:

* unigram: the path with the highest sum of piece scores, the earlier start on
  a tie;
* BPE: a segmentation is the one that merging gives exactly if every two
  neighbours are what merging makes of their joint text, so a position's last
  piece is the one that fits the last piece before it (a transition that is
  either free or forbidden; exactly one is free).

A character in no piece is an unknown piece of its own, written as its UTF-8
bytes where the model has byte pieces.  No path can cross an edge between two
characters that no piece holds side by side, such as a space after a
non-space, so paths always meet there; tasks remember the ids of the stretches
between such edges, up to ``CACHE`` of them.

The model file is a parameter and is read on the driver; models that normalise
text by a character map are refused.  Defined cases: null text counts as empty
and has no ids; every other text decodes to itself, except that U+2581 in it
decodes to a space.  Rows repeated or tied are encoded each and equally, an
empty table gives an empty result.  Extra columns pass; a column that clashes
with a result column is replaced.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from daybook.llm.near_dedup import small_batches

SPACE = "▁"
CACHE, SHORT = 1 << 19, 64
MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
UNIGRAM, BPE = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6


class Pieces:
    """A model's vocabulary, and what its kind needs to choose last pieces."""

    def __init__(self, entries: list[tuple[str, float, int]], kind: int, dummy_prefix: bool = True):
        self.entries, self.kind, self.dummy_prefix = entries, kind, dummy_prefix
        self.ids = {p: i for i, (p, _, t) in enumerate(entries) if t in (_NORMAL, _USER)}
        self.scores = [s for _, s, _ in entries]
        self.unknown = next((i for i, e in enumerate(entries) if e[2] == _UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(entries) if t == _BYTE}
        self.longest = max(map(len, self.ids), default=1)
        self._tree: dict | None = None  # made where it is used
        self.alphabet = {c for p in self.ids for c in p}
        self.unknown_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        self._fits: dict[int, dict[int, bool]] = {}  # by piece before, then piece
        self._remembered = 0
        # how merging makes each piece, filled as pieces are met
        self._made: dict[str, tuple[int, str, str] | None] = {}
        self.order = {s: n for n, s in enumerate(sorted({self.scores[i] for i in self.ids.values()}, reverse=True))}
        self.inside = {pair for p in self.ids for pair in zip(p, p[1:])}  # two characters that some piece holds side by side
        crossing = any(a != SPACE and b == SPACE for a, b in self.inside)
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in self.alphabet)
        apart = f"[{alone}]" if alone else "(?!)"
        self.stretch = re.compile(f"{apart}|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if not crossing else "(?s).+")

    @property
    def tree(self) -> dict:
        """Nested dictionaries by character; the id of a piece that ends at a
        node is under the empty string."""
        if self._tree is None:
            self._tree = {}
            for piece, i in self.ids.items():
                node = self._tree
                for c in piece:
                    node = node.setdefault(c, {})
                node[""] = i
        return self._tree

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        norm = m.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models that leave the text as it is are supported")
        if m.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        return cls([(p.piece, p.score, p.type) for p in m.pieces], m.trainer_spec.model_type, norm.add_dummy_prefix)

    def _rank(self, text: str) -> int | None:
        """Place of a piece in the order of merging; None if it is no piece."""
        i = self.ids.get(text)
        return None if i is None else self.order[self.scores[i]]

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: the best-scored pair first, the
        leftmost on a tie."""
        return [p for p, *_ in self._merge(text)]

    def _merge(self, text: str) -> list[tuple[str, int, str, str]]:
        """``merged`` with, for each part, the latest rank reached while it was
        made (-1 for a character) and the two parts joined last."""
        parts = [(c, -1, "", "") for c in text]
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self._rank(parts[i][0] + parts[i + 1][0])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts
            x, y = parts[at], parts[at + 1]
            parts[at:at + 2] = [(x[0] + y[0], max(best, x[1], y[1]), x[0], y[0])]

    def _history(self, piece: str) -> tuple[int, str, str] | None:
        """(latest rank, left part, right part) of a piece that merging makes
        of its own text; None for one it does not make."""
        if piece not in self._made:
            if len(piece) == 1:
                self._made[piece] = (-1, "", "")
            else:
                parts = self._merge(piece)
                self._made[piece] = parts[0][1:] if len(parts) == 1 else None
        return self._made[piece]

    def _apart(self, x: str, y: str) -> bool:
        """Whether merging never joins across the edge between two pieces.

        All joins up to a rank are done before any of a later rank, so the
        parts that touch the edge can be undone from the latest rank back.  In
        each state, the two parts at the edge would be joined if that comes
        before one of them goes into a larger part.  Where ranks tie, the
        order inside a rank decides, so merging itself is asked.
        """
        text, limit = (x, y), None
        hx, hy = self._history(x), self._history(y)
        if hx is None or hy is None:
            return False
        while True:
            join = self._rank(x + y)
            if join is not None:
                at = max(join, hx[0], hy[0])
                if limit is None or at < limit:
                    return False
                if at == limit:
                    break
            if hx[0] == hy[0]:
                if hx[0] < 0:
                    return True
                break
            if hx[0] > hy[0]:
                limit, x = hx[0], hx[2]
                hx = self._history(x)
            else:
                limit, y = hy[0], hy[1]
                hy = self._history(y)
            if hx is None or hy is None:
                break
        return self.merged("".join(text)) == list(text)

    def fits(self, before: int, piece: int) -> bool:
        """Whether merging keeps ``piece`` after ``before`` (-1: unknown or the start)."""
        own = self.entries[piece][0]
        ok = self._history(own) is not None if before < 0 else self._apart(self.entries[before][0], own)
        self._remembered += 1
        if self._remembered > CACHE:
            self._fits.clear()
            self._remembered = 1
        self._fits.setdefault(before, {})[piece] = ok
        return ok

    def after(self, before: int) -> dict[int, bool]:
        """What is known of the pieces after ``before``."""
        return self._fits.get(before) or self._fits.setdefault(before, {})


class Viterbi:
    """Feed characters, collect committed ids; ``waiting`` is all it holds."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        # a node is (position, node before, ids of the last piece, last piece or -1, score)
        root = (0, None, (), -1, 0.0)
        self.window = {0: root}
        self.committed = root
        self.text, self.start, self.done = "", 0, 0  # characters from position start; nodes are extended up to done

    @property
    def waiting(self) -> int:
        """Characters held."""
        return len(self.text)

    def feed(self, chunk: str) -> list[int]:
        self.text += chunk
        longest = self.p.longest
        stop = self.start + len(self.text) - longest + 1  # pieces from positions before it are seen whole
        out: list[int] = []
        while self.done < stop:
            self._extend(min(stop, self.done + longest))
            out += self._commit()
        return out

    def finish(self) -> list[int]:
        end = self.start + len(self.text)
        self._extend(end)
        path, n = [], self.window[end]
        while n is not self.committed:
            path.append(n[2])
            n = n[1]
        return [i for ids in reversed(path) for i in ids]

    def _extend(self, stop: int) -> None:
        """Try all pieces that start at positions done..stop-1."""
        p, text, start, window = self.p, self.text, self.start, self.window
        tree, scores, fits, after, bpe = p.tree, p.scores, p.fits, p.after, p.kind == BPE
        size = len(text)
        for off in range(self.done - start, stop - start):
            node = window.pop(off + start)  # its followers point to it
            before, score = node[3], node[4]
            known = after(before) if bpe else {}
            branch, end = tree, off
            while end < size:
                branch = branch.get(text[end])
                if branch is None:
                    break
                end += 1
                if "" not in branch:
                    continue
                i, to = branch[""], end + start
                if bpe:
                    if to not in window:
                        ok = known.get(i)
                        if ok if ok is not None else fits(before, i):
                            window[to] = (to, node, (i,), i, 0.0)
                else:
                    total = score + scores[i]
                    if to not in window or total > window[to][4]:
                        window[to] = (to, node, (i,), i, total)
            c = text[off]
            if "" not in tree.get(c, ()):  # no piece of one character: the unknown piece
                to, total = off + 1 + start, score + p.unknown_score
                if to not in window or not bpe and total > window[to][4]:
                    window[to] = (to, node, tuple(p.bytes[x] for x in c.encode()) if p.bytes else (p.unknown,), -1, total)
        self.done = stop

    def _commit(self) -> list[int]:
        """The ids up to the boundary where all surviving paths meet."""
        live = {id(n): n for n in self.window.values()}
        while len(live) > 1:
            last = max(live.values(), key=lambda n: n[0])
            del live[id(last)]
            live[id(last[1])] = last[1]
        meet = next(iter(live.values()))
        path, n = [], meet
        while n is not self.committed:
            path.append(n[2])
            n = n[1]
        # cut the pointer back, so that what is committed can be freed
        fresh = (meet[0], None, (), meet[3], meet[4])
        self._rebase(meet, fresh)
        self.committed = fresh
        self.text, self.start = self.text[self.done - self.start:], self.done
        return [i for ids in reversed(path) for i in ids]

    def _rebase(self, old: tuple, new: tuple) -> None:
        made = {id(old): new}

        def copy(n: tuple) -> tuple:
            chain = []
            while id(n) not in made:
                chain.append(n)
                n = n[1]
            m = made[id(n)]
            for c in reversed(chain):
                m = (c[0], m, *c[2:])
                made[id(c)] = m
            return m
        self.window = {k: copy(n) for k, n in self.window.items()}


def search_whole(text: str, p: Pieces) -> list[int]:
    """The same search over a text that is one window: no position leaves it
    before the end, so all paths are committed there, at once."""
    tree, scores, fits, after, bpe, n = p.tree, p.scores, p.fits, p.after, p.kind == BPE, len(text)
    last, came, best = [None] * (n + 1), [0] * (n + 1), [0.0] * (n + 1)
    last[0] = -1
    for at, c in enumerate(text):
        before, branch, end = last[at], tree, at
        known = after(before) if bpe else {}
        while end < n:
            branch = branch.get(text[end])
            if branch is None:
                break
            end += 1
            if bpe:
                if last[end] is None and "" in branch:
                    i = branch[""]
                    ok = known.get(i)
                    if fits(before, i) if ok is None else ok:
                        last[end], came[end] = i, at
            elif "" in branch:
                total = best[at] + scores[branch[""]]
                if last[end] is None or total > best[end]:
                    last[end], came[end], best[end] = branch[""], at, total
        if "" not in tree.get(c, ()):  # no piece of one character: the unknown piece
            total = best[at] + p.unknown_score
            if last[at + 1] is None or not bpe and total > best[at + 1]:
                last[at + 1], came[at + 1], best[at + 1] = -1, at, total
    out: list[int] = []
    while n:
        i, n = (last[n], n), came[n]
        if i[0] >= 0:
            out.append(i[0])
        elif p.bytes:
            out += [p.bytes[x] for x in reversed(text[n:i[1]].encode())]
        else:
            out.append(p.unknown)
    out.reverse()
    return out


def search(text: str, pieces: Pieces) -> list[int]:
    """The ids of a stretch of prepared text."""
    if len(text) <= SHORT:
        return search_whole(text, pieces)
    v = Viterbi(pieces)
    out: list[int] = []
    for at in range(0, len(text), 4096):
        out += v.feed(text[at:at + 4096])
    return out + v.finish()


class Stretches(dict):
    """Packed int32 ids of a stretch, remembered while there is room."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, stretch: str) -> bytes:
        if len(stretch) <= SHORT:
            packed = array("i", search(stretch, self.pieces)).tobytes()
            if len(self) >= CACHE:
                self.clear()
            self[stretch] = packed
            return packed
        inside = self.pieces.inside
        edges = [i for i, pair in enumerate(zip(stretch, stretch[1:]), 1) if pair not in inside]
        if edges:
            return b"".join([self[stretch[a:b]] for a, b in zip([0, *edges], [*edges, len(stretch)])])
        return array("i", search(stretch, self.pieces)).tobytes()


def encode_text(text: str, known: Stretches) -> bytes:
    """Packed int32 ids of a whole text."""
    if not text:
        return b""
    prepared = (SPACE if known.pieces.dummy_prefix else "") + text.replace(" ", SPACE)
    return b"".join(map(known.__getitem__, known.pieces.stretch.findall(prepared)))


def decode_table(pieces: Pieces) -> list[bytes]:
    def surface(piece: str, kind: int) -> bytes:
        if kind == _BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == _CONTROL:
            return b""
        return " ⁇ ".encode() if kind == _UNKNOWN else piece.replace(SPACE, " ").encode()
    return [surface(p, t) for p, _, t in pieces.entries]


def decode_ids(ids: list[int], table: list[bytes], dummy_prefix: bool) -> str:
    text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if dummy_prefix and text.startswith(" ") else text


def encode(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """``docs`` with ids (array<int>) of the whole text."""
    base = docs.drop("ids")
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Stretches(pieces)
        for batch in batches:
            for part in small_batches(batch):
                packed = [encode_text(t.as_py() or "", known) for t in part.column("text")]
                offsets = np.r_[0, np.cumsum([len(x) // 4 for x in packed])].astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in names} | {"ids": ids})
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def round_trip(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """``docs`` without the text, with its ids and whether they decode to it
    (``round_trip``): both directions in one pass, and no text leaves it."""
    base = docs.drop("ids", "round_trip")
    names = [c for c in base.columns if c != "text"]
    schema = T.StructType([*[base.schema[c] for c in names], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("round_trip", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table, prefix = Stretches(pieces), decode_table(pieces), pieces.dummy_prefix
        for batch in batches:
            for part in small_batches(batch):
                packed, same = [], []
                for t in part.column("text"):
                    text = t.as_py() or ""
                    packed.append(encode_text(text, known))
                    same.append(decode_ids(array("i", packed[-1]).tolist(), table, prefix) == text)
                offsets = np.r_[0, np.cumsum([len(x) // 4 for x in packed])].astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in names} | {"ids": ids, "round_trip": pa.array(same, pa.bool_())})
    return base.mapInArrow(run, schema)


def decode(rows: DataFrame, pieces: Pieces, into: str = "decoded") -> DataFrame:
    """``rows`` with the text of ids; null ids give an empty text."""
    base = rows.drop(into)
    names, table, prefix = base.columns, decode_table(pieces), pieces.dummy_prefix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                text = [decode_ids(x.values.to_numpy().tolist() if x.is_valid else [], table, prefix) for x in part.column("ids")]
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in names} | {into: pa.array(text, pa.string())})
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(into, T.StringType())]))
