"""Line dedup with two Bloom filters: once seen and twice seen.

A line's key is the line without white space at both ends, A-Z in lower case;
empty keys never count.  Every task puts the keys of its documents into two
filters of its own: a key already in the first goes into the second.  Merging
two tasks, twice = t1 | t2 | (o1 & o2), so a key of two documents is always in
the merged second filter, whichever tasks read them.  Only lines whose key is
in it, the suspected repeats, are shuffled, as 128-bit digests; their counts
of documents are exact, and a false positive of a filter only costs a row.

The filters are cut into segments of ``SEGMENT_BITS``.  Their size follows the
number of lines (``BITS_PER_LINE`` each) up to ``MAX_BITS``; at most
MAX_BITS / 8 bytes reach the driver and each task.  Past that more lines are
suspected, none is missed.

Keys found in at least ``min_docs`` documents lose their lines: with
``keep="none"`` all of them, with ``keep="first"`` all but the first
occurrence (smallest doc_id, then checksum of the text, then line).

Defined cases: a null or empty text is one empty line and stays as it is (null
becomes empty in the result); a key repeated inside one document counts once;
every row is a document, also a repeated one; rows with the same doc_id and
text share one verdict; an empty table gives an empty result.  Extra columns
pass; a column that clashes with a result column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import WS, cut, give_back, join_salted, small_batches, whole_text

BITS_PER_LINE, SEGMENT_BITS, MAX_BITS, PROBES = 8, 1 << 19, 1 << 30, 4
_WS = WS.encode()


def line_keys(text: str) -> list[bytes]:
    return [line.strip(_WS).lower() for line in text.encode().split(b"\n")]


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _positions(digests: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment, and PROBES bit numbers inside it, of (n, 2) uint64 digests."""
    seg = (digests[:, 0] % np.uint64(segments)).astype(np.int64)
    step = (digests[:, 1] >> np.uint64(32)) | np.uint64(1)
    start = digests[:, 1] & np.uint64(0xFFFFFFFF)
    probes = start[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)
    return seg, (probes % np.uint64(SEGMENT_BITS)).astype(np.int64)


class Filters:
    """The two filters of one task, segment by segment as they are needed."""

    def __init__(self, segments: int):
        self.segments = segments
        self.once: dict[int, np.ndarray] = {}
        self.twice: dict[int, np.ndarray] = {}

    @staticmethod
    def _put(bits: np.ndarray, at: np.ndarray) -> None:
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))

    @staticmethod
    def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)

    def add(self, digests: np.ndarray) -> None:
        """Rows of (n, 2) uint64, one for each document and key."""
        if not len(digests):
            return
        distinct, n = np.unique(digests, axis=0, return_counts=True)
        seg, at = _positions(distinct, self.segments)
        order = np.argsort(seg, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(seg[order])) + 1):
            s = int(seg[part[0]])
            once = self.once.setdefault(s, np.zeros(SEGMENT_BITS // 8, np.uint8))
            again = self._has(once, at[part]) | (n[part] > 1)
            if again.any():
                twice = self.twice.setdefault(s, np.zeros(SEGMENT_BITS // 8, np.uint8))
                self._put(twice, at[part][again].ravel())
            self._put(once, at[part].ravel())

    def merge(self, s: int, once: bytes, twice: bytes | None) -> None:
        o = np.frombuffer(once, np.uint8)
        t = np.frombuffer(twice, np.uint8) if twice else np.zeros_like(o)
        if s in self.once:
            both = self.once[s] & o
            self.twice[s] = self.twice[s] | t | both if s in self.twice else t | both
            self.once[s] = self.once[s] | o
        else:
            self.once[s] = o.copy()
            self.twice[s] = t.copy()

    def batches(self) -> Iterator[pa.RecordBatch]:
        for s, once in self.once.items():
            twice = self.twice.get(s)
            yield pa.RecordBatch.from_pydict(
                {"seg": pa.array([s], pa.int32()), "once": pa.array([once.tobytes()], pa.binary()),
                 "twice": pa.array([None if twice is None else twice.tobytes()], pa.binary())})


def has_twice(twice: dict[int, bytes], segments: int, digests: np.ndarray) -> np.ndarray:
    """Which of the (n, 2) digests are in the merged second filter."""
    out = np.zeros(len(digests), bool)
    if not len(digests):
        return out
    seg, at = _positions(digests, segments)
    for s in np.unique(seg):
        if bits := twice.get(int(s)):
            here = seg == s
            out[here] = Filters._has(np.frombuffer(bits, np.uint8), at[here])
    return out


def _as_array(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


def segments_for(lines: int) -> int:
    bits = min(max(lines * BITS_PER_LINE, SEGMENT_BITS), MAX_BITS)
    return -(-bits // SEGMENT_BITS)


def twice_seen(docs: DataFrame, segments: int) -> dict[int, bytes]:
    """The merged second filter by segment: MAX_BITS / 8 bytes at most."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Filters(segments)
        for batch in batches:
            for b in small_batches(batch):
                f.add(_as_array([digest(k) for t in b.column("text") for k in {*line_keys(t.as_py())} if k]))
        yield from f.batches()
        give_back()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Filters(segments)
        for b in batches:
            for s, once, twice in zip(*(b.column(c).to_pylist() for c in ("seg", "once", "twice"))):
                f.merge(s, once, twice)
        yield from f.batches()

    schema = "seg int, once binary, twice binary"
    merged = docs.select(whole_text().alias("text")).mapInArrow(build, schema).repartition("seg").mapInArrow(merge, schema)
    return {r["seg"]: bytes(r["twice"]) for r in merged.where("twice IS NOT NULL").select("seg", "twice").collect()}


def suspects(docs: DataFrame, twice: dict[int, bytes], segments: int) -> DataFrame:
    """(doc_id, text_md5, digest, lines): the suspected repeats of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(twice)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chain.from_iterable(map(small_batches, batches)):
            rows, found = [], []
            for r, t in enumerate(b.column("text")):
                at: dict[bytes, list[int]] = {}
                for i, k in enumerate(line_keys(t.as_py())):
                    if k:
                        at.setdefault(k, []).append(i)
                rows += [r] * len(at)
                found += [(digest(k), lines) for k, lines in at.items()]
            hit = np.flatnonzero(has_twice(shared.value, segments, _as_array([d for d, _ in found])))
            docs_hit = b.take(pa.array([rows[i] for i in hit], pa.int64()))
            yield pa.RecordBatch.from_pydict({
                "doc_id": docs_hit.column("doc_id"), "text_md5": docs_hit.column("text_md5"),
                "digest": pa.array([found[i][0] for i in hit], pa.binary()),
                "lines": pa.array([found[i][1] for i in hit], pa.list_(pa.int32()))})
        give_back()

    rows = docs.select("doc_id", F.unhex(F.md5(whole_text().cast("binary"))).alias("text_md5"),
                       whole_text().alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(find, f"doc_id {id_type}, text_md5 binary, digest binary, lines array<int>")


def dropped_lines(found: DataFrame, min_docs: int, keep: str) -> DataFrame:
    """(doc_id, text_md5, drop): line numbers that each document loses."""
    first = F.min(F.struct(F.col("doc_id"), F.col("text_md5"), F.array_min("lines").alias("line")))
    counts = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), first.alias("first")).where(F.col("n") >= min_docs)
    rows = join_salted(found, counts.select("digest", "first"), ["digest"])
    lines = F.col("lines")
    if keep == "first":
        is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_md5") == F.col("first.text_md5"))
        lines = F.when(is_first, F.filter("lines", lambda i: i != F.col("first.line"))).otherwise(lines)
    elif keep != "none":
        raise ValueError(f"keep is 'none' or 'first', not {keep!r}")
    per_doc = rows.select("doc_id", "text_md5", "digest", lines.alias("lines")).distinct()  # of repeated rows, one
    return per_doc.groupBy("doc_id", "text_md5").agg(F.flatten(F.collect_list("lines")).alias("drop"))


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, keep: str = "none") -> DataFrame:
    """``docs`` with repeated lines gone from text, and n_lines, n_dropped."""
    lines = F.char_length(whole_text()) - F.char_length(F.replace(whole_text(), F.lit("\n"), F.lit(""))) + 1
    segments = segments_for(docs.agg(F.sum(lines)).first()[0] or 0)
    found = cut(suspects(docs, twice_seen(docs, segments), segments))
    drops = dropped_lines(found, min_docs, keep).withColumnsRenamed(
        {"doc_id": "_drop_id", "text_md5": "_drop_md5", "drop": "_drop"})
    base = docs.drop("n_lines", "n_dropped").withColumn("text", whole_text())
    joined = base.join(drops, base["doc_id"].eqNullSafe(drops["_drop_id"])
                       & (F.unhex(F.md5(base["text"].cast("binary"))) == drops["_drop_md5"]), "left")
    names = base.columns
    joined = joined.select(*names, "_drop")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chain.from_iterable(map(small_batches, batches)):
            texts, n, gone = [], [], []
            for t, d in zip(b.column("text").to_pylist(), b.column("_drop").to_pylist()):
                parts, lose = t.split("\n"), set(d or ())
                texts.append("\n".join(x for i, x in enumerate(parts) if i not in lose) if lose else t)
                n.append(len(parts))
                gone.append(len(lose))
            cols = {c: b.column(c) for c in names} | {"text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_pydict(cols | {"n_lines": pa.array(n, pa.int64()), "n_dropped": pa.array(gone, pa.int64())})
        give_back()

    schema = T.StructType([*base.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return joined.mapInArrow(apply, schema)
