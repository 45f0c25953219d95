"""Document fingerprints by one-permutation MinHash (DataFrame functions only).

Every 5-word shingle is hashed once.  The top bits of a hash choose one of
``BINS`` bins and each bin keeps its smallest hash.  An empty bin is filled by
optimal densification: it walks a pseudo-random order of the bins of its own
and copies the first one that is not empty.  Of every bin the low ``BITS`` bits
are packed into the fingerprint.  Two unrelated bins agree with probability
1 / 2**BITS, so likeness is (p - c) / (1 - c) for the share p of agreeing
bins and c = 1 / 2**BITS, held within 0 and 1.

Defined cases: null text counts as empty; a text of fewer than five words has
one shingle, the whole; a text without words has the empty fingerprint '',
which is like itself (1.0) and like nothing else (0.0).  Rows repeated or with
equal texts have equal fingerprints; among equal doc_ids the next row is the
next text, and a null doc_id comes last.  The only row of a table is its own
next one; an empty table gives an empty result.  Extra columns are not read and
do not come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import let, whole_text, words

BINS, BITS, SHINGLE = 128, 4, 5
_PER_LONG = 64 // BITS  # bins in one packed long
_NIBBLE_LOW = 0x1111111111111111


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - (BINS - 1).bit_length()).cast("int")


def _densified(mins: Column) -> Column:
    """From the sorted minima of the non-empty bins, one value per bin."""
    def fill(bins: Column) -> Column:
        def value(i: Column) -> Column:
            # the first non-empty bin in the order that hashing gives to bin i
            order = F.transform(bins, lambda b: F.xxhash64(i, b).bitwiseAND(F.lit(-BINS)).bitwiseOR(b.cast("long")))
            donor = F.array_min(order).bitwiseAND(F.lit(BINS - 1)).cast("int")
            at = F.array_position(bins, i)
            return F.element_at(mins, F.when(at > 0, at).otherwise(F.array_position(bins, donor)).cast("int"))
        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)
    return let(F.transform(mins, _bin), fill)


def _packed(dense: Column) -> Column:
    """Low bits of the bins, ``_PER_LONG`` to a long."""
    def one(k: Column) -> Column:
        part = F.slice(dense, k * _PER_LONG + 1, F.lit(_PER_LONG))
        return F.aggregate(part, F.lit(0).cast("long"), lambda acc, v: F.shiftleft(acc, BITS).bitwiseOR(
            v.bitwiseAND(F.lit((1 << BITS) - 1))))
    return F.transform(F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)), one)


def signature(text: Column) -> Column:
    """Packed bins as array<long>; empty for a text without words."""
    def of_words(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1)))
        hashes = F.sort_array(F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, F.lit(SHINGLE)))))
        mins = let(hashes, lambda hs: F.filter(
            hs, lambda h, i: (i == 0) | (_bin(F.get(hs, i - 1)) != _bin(h))))
        packed = let(mins, lambda m: let(_densified(m), _packed))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(packed)
    return let(words(F.lower(text)), of_words)


def as_text(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda v: F.lpad(F.lower(F.hex(v)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two signatures, corrected for chance agreement."""
    def differing(x: Column) -> Column:
        spread = x
        for k in range(1, BITS):
            spread = spread.bitwiseOR(F.shiftrightunsigned(x, k))
        return F.bit_count(spread.bitwiseAND(F.lit(_NIBBLE_LOW)))
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0),
                         lambda acc, x: acc + differing(x))
    c = 1.0 / (1 << BITS)
    corrected = (1.0 - differ / F.lit(float(BINS)) - c) / (1.0 - c)
    none_a, none_b = F.size(a) == 0, F.size(b) == 0
    return (F.when(none_a & none_b, F.lit(1.0)).when(none_a | none_b, F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), corrected))))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with fingerprint, from whole texts; other columns pass."""
    return docs.withColumn("fingerprint", as_text(signature(whole_text())))


def _range_of(x: Column, cuts: list[int]) -> Column:
    """Number of the range that ``x`` falls in: 0 for null, then 1 and on by
    rising value.  Looks through every ``step``-th cut, then through one step."""
    if not cuts:
        return F.when(x.isNull(), F.lit(0)).otherwise(F.lit(1))
    step = max(1, int(len(cuts) ** 0.5))

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda c: c < x))

    skipped = F.greatest(below(F.lit(cuts[::step])) - 1, F.lit(0)) * step
    return F.when(x.isNull(), F.lit(0)).otherwise(
        let(skipped, lambda k: k + below(F.slice(F.lit(cuts), k + 1, F.lit(step))) + 1))


def with_next(docs: DataFrame, rows_per_range: int = 8000, most_ranges: int = 16384) -> DataFrame:
    """Each (doc_id, text, sig) with next_text and next_sig: those of the next
    row by descending doc_id (null last, then by text), the first after the
    last.

    Rows are cut into ranges of doc_id of about ``rows_per_range`` rows (more,
    where that would make over ``most_ranges`` ranges), and each range also gets a copy of the first row of the next one, so ``lead``
    works range by range and no task sees all rows.  Only the range bounds and
    the first id of each range come to the driver.
    """
    n = docs.select("doc_id").count()
    parts = min(max(1, -(-n // rows_per_range)), most_ranges)
    cuts = sorted(set(docs.select("doc_id").where("doc_id IS NOT NULL").approxQuantile(
        "doc_id", [i / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    ranged = docs.withColumn("_range", _range_of(F.col("doc_id"), [int(c) for c in cuts]))
    tops = {r["_range"]: r["top"] for r in ranged.select("_range", "doc_id").groupBy("_range")
            .agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(tops, reverse=True)  # in reading order
    follow = dict(zip(order, order[1:] + order[:1]))  # range -> the range read after it
    before = {v: k for k, v in follow.items()}
    ids = [v for v in tops.values() if v is not None]
    wanted = F.col("doc_id").isin(ids) if ids else F.lit(False)
    if None in tops.values():
        wanted = wanted | F.col("doc_id").isNull()
    top = W.partitionBy("_range").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    heads = (ranged.where(wanted).withColumn("_rank", F.row_number().over(top)).where("_rank = 1").drop("_rank")
             .replace(before, subset=["_range"]) if before else ranged.limit(0))
    rows = ranged.withColumn("_copy", F.lit(0)).unionByName(heads.withColumn("_copy", F.lit(1)))
    w = W.partitionBy("_range").orderBy("_copy", F.col("doc_id").desc_nulls_last(), "text")
    return (rows.withColumn("next_text", F.lead("text").over(w)).withColumn("next_sig", F.lead("sig").over(w))
            .where("_copy = 0").drop("_copy", "_range"))


def edited_and_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text (the last third
    replaced by the start of the next document), with likenesses."""
    base = docs.select("doc_id", whole_text().alias("text"))
    paired = with_next(base.withColumn("sig", signature(F.col("text"))))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - third), F.substr("next_text", F.lit(1), third))
    out = paired.select("doc_id", "sig", "next_sig", n.cast("long").alias("n_chars"), edited.alias("edited"))
    out = out.select("doc_id", "sig", "next_sig", "n_chars",
                     F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                     signature(F.col("edited")).alias("edited_sig"))
    return out.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("sig")).alias("fingerprint"),
                      as_text(F.col("edited_sig")).alias("edited_fingerprint"),
                      likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
                      likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
