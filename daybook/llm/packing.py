"""Packing into optimal length buckets and token-budget batches.

The histogram of document lengths over the whole table (one count per distinct
length) goes to the driver, and a dynamic program chooses the ``BUCKETS``
upper bounds with the least padding overall: a document is padded to the bound
of its bucket.  Inside a bucket, documents fill batches of ``BUDGET`` padded
tokens, so a batch of the bucket with bound b holds max(1, BUDGET // b)
documents.  A document longer than the budget is a batch by itself, whole.

Lengths are counts of words between white space plus one end token, or a column
of the table (``length``), such as the ``n_tokens`` of
:func:`daybook.llm.token_counts.count_tokens`, which is what a text without
white space needs.

Defined cases: null text counts as empty (one token), a null length as 1 and a
length under 1 as 1; extra columns are not read and do not come out; rows with equal lengths
are in one bucket and take places by hash of their doc_id, then doc_id, then
checksum of the text; repeated rows take places of their own; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut, numbered, whole_text, words

BUCKETS, BUDGET, CELLS = 16, 65536, 1024


def token_count(text: Column) -> Column:
    return (F.size(words(text)) + 1).cast("long")


def best_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    best[k][j] = min over i < j of best[k-1][i] + cost(i, j), where cost(i, j)
    pads lengths i+1..j to length j.  With C and T the running counts and
    tokens, cost is len_j * (C_j - C_i) - (T_j - T_i), so for each k the
    candidates i are lines of slope -C_i asked at rising len_j: a lower hull
    walked once.
    """
    lengths = sorted(histogram)
    n = len(lengths)
    if n == 0:
        return []
    count, tokens = [0], [0]
    for x in lengths:
        count.append(count[-1] + histogram[x])
        tokens.append(tokens[-1] + x * histogram[x])
    best = [0] + [lengths[j - 1] * count[j] - tokens[j] for j in range(1, n + 1)]  # one bucket
    back = [[0] * (n + 1)]
    for _ in range(min(buckets, n) - 1):
        hull: list[tuple[int, int, int]] = []  # slope, intercept, i
        at, now, came = 0, best[:], [0] * (n + 1)
        for j in range(1, n + 1):
            i = j - 1
            m, b = -count[i], best[i] + tokens[i]
            while len(hull) >= 2:
                (m1, b1, _), (m2, b2, _) = hull[-2], hull[-1]
                if (b - b1) * (m1 - m2) <= (b2 - b1) * (m1 - m):
                    hull.pop()
                else:
                    break
            hull.append((m, b, i))
            at = min(at, len(hull) - 1)
            x = lengths[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            now[j] = hull[at][0] * x + hull[at][1] + x * count[j] - tokens[j]
            came[j] = hull[at][2]
        best = now
        back.append(came)
    bounds, j = [], n
    for came in reversed(back):
        if j == 0:
            break
        bounds.append(lengths[j - 1])
        j = came[j]
    return sorted(bounds)


def padding(histogram: dict[int, int], bounds: list[int]) -> int:
    return sum(n * (next(b for b in bounds if b >= x) - x) for x, n in histogram.items())


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, length: str | None = None) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_len, batch, place, padding of every row."""
    # the texts are read once; what follows needs three numbers a row
    tokens = F.greatest(F.col(length).cast("long"), F.lit(1).cast("long")) if length else token_count(whole_text())
    rows = cut(docs.select("doc_id", tokens.alias("n_tokens"),
                           F.crc32(whole_text().cast("binary")).alias("_crc")))
    histogram = {r["n_tokens"]: r["count"] for r in rows.groupBy("n_tokens").count().collect()}
    bounds = best_bounds(histogram, buckets)
    if not bounds:
        bounds = [1]
    starts = F.lit([0, *bounds[:-1]])  # a bucket takes lengths above its start
    bucket = F.size(F.filter(starts, lambda s: s < F.col("n_tokens"))) - 1
    placed = (rows.withColumn("bucket", bucket)
              .withColumn("bucket_len", F.element_at(F.lit(bounds), F.col("bucket") + 1).cast("long")))
    cell = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.col("_crc"))), F.lit(CELLS)).cast("int")
    ranked = numbered(placed, ["bucket"], cell, [F.xxhash64("doc_id"), F.col("doc_id"), F.col("_crc"),
                                                 F.col("n_tokens")], "_rank")
    per_batch = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.col("bucket_len")))
    return ranked.select("doc_id", "n_tokens", "bucket", "bucket_len",
                         F.floor(F.col("_rank") / per_batch).cast("long").alias("batch"),
                         (F.col("_rank") % per_batch).cast("long").alias("place"),
                         (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
