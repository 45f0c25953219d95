"""Token counts by a dynamic program over prefixes, without writing any ids.

For a BPE model the encoding of a prefix ends in one piece, and without that
piece it is the encoding of the shorter prefix.  So one walk over a text gives
the exact count of every prefix:

    count[j] = count[j - length of the last piece at j] + 1

where the last piece is the one that merging keeps after the last piece of the
shorter prefix (:meth:`Pieces.fits`).  The counts of all prefixes are kept, so
"how many tokens has this prefix", "how much of the text fits a budget" and
"where to cut the text into parts" are lookups, not encodings.

No piece crosses an edge between two stretches (a space after a non-space, or
two characters that no piece holds side by side), so a text's counts are those
of its stretches, each on top of the total before it.  A task remembers the
prefix counts of up to ``CACHE`` short stretches; :class:`PrefixCounts` keeps
the running totals at the stretches' ends and a reference to each stretch's own
counts.

Counts are those of the sentencepiece library for the model, without begin or
end tokens; a character in no piece counts one token per UTF-8 byte where the
model has byte pieces, else one.  Unigram models are refused: there the last
piece of a prefix follows from scores, which is what the codec is for.

Defined cases: null text counts as empty and has 0 tokens; the empty prefix has
0; very long texts are walked stretch by stretch, a stretch without inner edges
in one pass that holds three numbers a character; rows repeated or tied are
counted each and equally; an empty table gives an empty result; extra columns
pass, and a column that clashes with a result column is replaced.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from daybook.llm.near_dedup import small_batches
from daybook.llm.sentencepiece_codec import BPE, SPACE, Pieces

LIMIT = 4096
CACHE, SHORT = 1 << 19, 64


def prefix_counts(stretch: str, pieces: Pieces) -> list[int]:
    """Tokens of every prefix of a stretch of prepared text, from the prefix of
    one character on."""
    n, tree, after, fits = len(stretch), pieces.tree, pieces.after, pieces.fits
    count, last = [0] * (n + 1), [None] * (n + 1)
    last[0] = -1
    for at, c in enumerate(stretch):
        before = last[at]
        known, node, end = after(before), tree, at
        while end < n:
            node = node.get(stretch[end])
            if node is None:
                break
            end += 1
            if last[end] is None and "" in node:
                i = node[""]
                ok = known.get(i)
                if fits(before, i) if ok is None else ok:
                    last[end], count[end] = i, count[at] + 1
        if last[at + 1] is None and "" not in tree.get(c, ()):  # in no piece: the unknown piece, as its bytes
            last[at + 1], count[at + 1] = -1, count[at] + (len(c.encode()) if pieces.bytes else 1)
    return count[1:]


class Stretches(dict):
    """Prefix counts of stretches, remembered while there is room."""

    def __init__(self, pieces: Pieces):
        if pieces.kind != BPE:
            raise ValueError("prefix counts are of BPE models")
        super().__init__()
        self.pieces = pieces

    def __missing__(self, stretch: str) -> bytes | list[int]:
        if len(stretch) <= SHORT:
            out = prefix_counts(stretch, self.pieces)
            if max(out) < 256:  # a byte a prefix
                out = bytes(out)
            if len(self) >= CACHE:
                self.clear()
            self[stretch] = out
            return out
        inside, out, total = self.pieces.inside, [], 0
        edges = [i for i, pair in enumerate(zip(stretch, stretch[1:]), 1) if pair not in inside]
        for x, y in zip([0, *edges], [*edges, len(stretch)]):
            part = self[stretch[x:y]] if edges else prefix_counts(stretch, self.pieces)
            out += [total + k for k in part]
            total = out[-1]
        return out


class PrefixCounts:
    """Exact token counts of every prefix of one text, by code points."""

    def __init__(self, text: str, known: Stretches):
        p = known.pieces
        self.size, self.extra = len(text), int(p.dummy_prefix)
        prepared = (SPACE if p.dummy_prefix else "") + text.replace(" ", SPACE) if text else ""
        self.parts = list(map(known.__getitem__, p.stretch.findall(prepared)))
        self.chars = [0, *accumulate(map(len, self.parts))]  # of prepared text, before each part
        self.tokens = [0, *accumulate(x[-1] for x in self.parts)]

    @property
    def total(self) -> int:
        return self.tokens[-1]

    def at(self, chars: int) -> int:
        """Tokens of the first ``chars`` characters."""
        if min(chars, self.size) <= 0:
            return 0
        end = min(chars, self.size) + self.extra
        k = bisect.bisect_left(self.chars, end) - 1
        return self.tokens[k] + self.parts[k][end - self.chars[k] - 1]

    def longest_within(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens.  A
        longer prefix may have fewer tokens than a shorter one, but not fewer
        than the stretches before its last one."""
        k = bisect.bisect_right(self.tokens, budget) - 1  # all parts before the k-th fit
        if k == len(self.parts):
            return self.size
        room = budget - self.tokens[k]
        inside = max((j for j, x in enumerate(self.parts[k], 1) if x <= room), default=0)
        return max(0, self.chars[k] + inside - self.extra)

    def every(self) -> list[int]:
        """Tokens of the prefixes of 0, 1, ... all characters."""
        out = [0]
        for base, part in zip(self.tokens, self.parts):
            out += [base + x for x in part]
        return [0, *out[1 + self.extra:]]


def count_tokens(docs: DataFrame, pieces: Pieces, limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than
    ``limit`` tokens) and ``fitting_chars``, the code points of the longest
    prefix of at most ``limit`` tokens."""
    added = [("n_bytes", T.LongType(), pa.int64()), ("n_tokens", T.LongType(), pa.int64()),
             ("over_limit", T.BooleanType(), pa.bool_()), ("fitting_chars", T.LongType(), pa.int64())]
    base = docs.drop(*[name for name, *_ in added])
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Stretches(pieces)
        for batch in batches:
            for part in small_batches(batch):
                rows = []
                for t in part.column("text"):
                    text = t.as_py() or ""
                    counts = PrefixCounts(text, known)
                    rows.append((len(text.encode()), counts.total, counts.total > limit, counts.longest_within(limit)))
                new = {name: pa.array([r[k] for r in rows], kind) for k, (name, _, kind) in enumerate(added)}
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in names} | new)
    return base.mapInArrow(run, T.StructType([*base.schema.fields, *[T.StructField(n, t) for n, t, _ in added]]))
