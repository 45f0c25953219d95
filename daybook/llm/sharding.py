"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VNODES`` points on a ring of ``CELLS`` cells.  A row hashes
to a cell and belongs to the first point met clockwise.  A shard takes rows up
to its bound only; rows beyond it continue clockwise to the next shard with
room.  The bounds are the exact even split (n // shards, one more for the
first n % shards), so counts of shards differ by one row at most, the law
``rows``.

Only counts per cell reach the driver (``CELLS`` numbers, whatever the size of
the input), and what returns to the executors is the plan: for each cell,
which of its rows by rank go to which shard.  Rows are ranked cell by cell.

Defined cases: null text counts as no bytes; rows with a null doc_id are
placed by their text's checksum.  Repeated rows are rows of their own and get
slots of their own; rows that tie in all that orders a cell (doc_id, checksum,
size) take its slots in either order.  An empty table gives an empty result.
Extra columns are not read and do not come out.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import whole_text

CELLS, VNODES, SHARDS = 16384, 64, 16
PLAN_SCHEMA = "_cell int, lo long, hi long, shard int, slot0 long"


def ring(shards: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    def cell(s: int, v: int) -> int:
        return int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") % CELLS
    return sorted((cell(s, v), s) for s in range(shards) for v in range(VNODES))


def plan(counts: dict[int, int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (cell, lo, hi, shard, slot0): ranks lo..hi-1 of a cell go to that
    shard, at slots from slot0 on.  Cells are served in a fixed scattered
    order, so no stretch of the ring is always the last to be served."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    load = [0] * shards
    nodes = ring(shards)
    points = [c for c, _ in nodes]
    out = []
    for cell in sorted(counts, key=lambda c: hashlib.sha256(b"%d" % c).digest()):
        lo, n = 0, counts[cell]
        at = bisect.bisect_left(points, cell)
        while lo < n:
            s = nodes[at % len(nodes)][1]
            take = min(n - lo, room[s] - load[s])
            if take > 0:
                out.append((cell, lo, lo + take, s, load[s]))
                load[s] += take
                lo += take
            at += 1
    return out


def ring_cell(doc_id: Column, crc: Column) -> Column:
    key = F.coalesce(doc_id.cast("long"), crc)
    return F.shiftrightunsigned(F.xxhash64(key), 64 - (CELLS - 1).bit_length()).cast("int")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row."""
    raw = whole_text().cast("binary")
    rows = docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    keyed = rows.withColumn("_cell", ring_cell(F.col("doc_id"), F.col("text_crc32")))
    ids_only = keyed if docs.where("doc_id IS NULL").limit(1).count() else \
        docs.select(ring_cell(F.col("doc_id"), F.lit(0).cast("long")).alias("_cell"))
    counts = {r["_cell"]: r["count"] for r in ids_only.groupBy("_cell").count().collect()}
    spark = docs.sparkSession
    moves = spark.createDataFrame(plan(counts, shards), PLAN_SCHEMA)
    # at most one row per cell and one more per shard that fills up
    ranked = keyed.withColumn("_rank", F.row_number().over(
        W.partitionBy("_cell").orderBy(F.xxhash64("doc_id"), "doc_id", "text_crc32", "size")) - 1)
    return (ranked.join(F.broadcast(moves), "_cell").where("_rank >= lo AND _rank < hi")
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("slot0") + F.col("_rank") - F.col("lo")).cast("long").alias("slot")))
