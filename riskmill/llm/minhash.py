"""One-permutation MinHash fingerprints in DataFrame functions only.

Every shingle of a text is hashed once. The high bits of the hash choose one of 128
bins, a bin keeps its smallest hash, and of that the lowest 8 bits. An empty bin borrows
from the first occupied one of a fixed pseudo-random sequence of its own (optimal
densification), so that two texts borrow alike and no two bins depend on each other.
Packed, a fingerprint has 128 bytes. Two unequal minima still agree in 8 bits once in 256
times, which the likeness is corrected for.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskmill.llm.common import let, plain, text_or_empty

WORDS = 5
BIN_BITS, LOW_BITS = 7, 8
BINS = 1 << BIN_BITS
#: Bins tried in turn before the remaining order is computed from hashes.
TRIES = 8
#: doc_ids that share a bucket differ in these low bits only, so a bucket is bounded.
BUCKET_BITS = 12
SPACES = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Array of hashes: one per word shingle of the lower-case text, fewer words count as one shingle."""
    parts = F.array_remove(F.split(F.lower(text), SPACES), "")
    hashed = F.transform(parts, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        every = F.transform(
            F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(words)))
        )
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(
            F.size(h) < words, F.array(F.xxhash64(h))
        ).otherwise(every)

    return let(hashed, shingles)


def _bin(value: Column) -> Column:
    return F.shiftright(value, 64 - BIN_BITS) + BINS // 2


def _sequences() -> Column:
    """For every bin its own number and ``TRIES`` bins to borrow from, fixed for all texts."""
    rng = random.Random(17)
    return F.array(*(
        F.struct(F.lit(b).alias("own"), *(F.lit(rng.randrange(BINS)).alias(f"t{i}") for i in range(TRIES)))
        for b in range(BINS)
    ))


def sketch(text: Column, words: int = WORDS) -> Column:
    """Array of ``BINS`` bytes (tinyint); empty for a text without words."""

    def smallest(ordered: Column) -> Column:
        """The first hash of every occupied bin: high bits come first in the order."""
        return F.filter(ordered, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(ordered, i - 1))))

    def dense(found: Column) -> Column:
        bins = F.transform(found, _bin)
        return let(bins, lambda at: F.transform(
            F.sequence(F.lit(0), F.lit(BINS - 1)),
            lambda b: F.get(found, (F.array_position(at, b.cast("long")) - 1).cast("int"))))

    def borrow(found: Column, filled: Column) -> Column:
        def value(b: Column) -> Column:
            last = F.array_min(F.transform(found, lambda x: F.struct(F.xxhash64(b["own"], _bin(x)), x.alias("x"))))["x"]
            return F.coalesce(F.get(filled, b["own"]), *(F.get(filled, b[f"t{i}"]) for i in range(TRIES)), last)

        low = lambda b: value(b).bitwiseAND((1 << LOW_BITS) - 1)
        return F.transform(_sequences(), lambda b: (low(b) - (1 << LOW_BITS - 1)).cast("tinyint"))

    none = F.array().cast("array<tinyint>")
    whole = lambda found: F.when(F.size(found) == 0, none).otherwise(let(dense(found), lambda filled: borrow(found, filled)))
    return let(let(F.sort_array(shingle_hashes(text, words)), smallest), whole)


def packed(bins: Column) -> Column:
    """A sketch as lower-case hex, two digits per bin; empty for a text without words."""
    digits = F.transform(bins, lambda b: F.lower(F.lpad(F.hex(b.cast("int") + (1 << LOW_BITS - 1)), 2, "0")))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches, 0 to 1, corrected for chance agreement.

    Two texts without words are alike, one without words and another are not.
    """
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    chance = 1 / (1 << LOW_BITS)
    estimate = F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(estimate)


def _before(rows: DataFrame) -> DataFrame:
    """(bucket, source): for every bucket the largest doc_id below it; the lowest takes the largest of all.

    A table of one row per bucket is put in order within its parent range; only one row per parent
    (2 ** 24 consecutive ids) meets in a single task.
    """
    tops = rows.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    tops = tops.withColumn("parent", F.shiftright("bucket", BUCKET_BITS))
    inner = tops.withColumn("source", F.lag("top").over(Window.partitionBy("parent").orderBy("bucket")))
    parents = tops.groupBy("parent").agg(F.max("top").alias("parent_top"))
    order = Window.orderBy("parent")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parents = parents.select("parent", F.coalesce(F.lag("parent_top").over(order), F.max("parent_top").over(whole)).alias("outer"))
    return inner.join(parents, "parent").select("bucket", F.coalesce("source", "outer").alias("source"))


def with_next(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` with ``next_<column>`` of the next document in descending doc_id; after the last comes the first.

    Rows are dealt out once, by ranges of doc_id so short that a range is a bounded
    group. Each range also gets a copy of the first row of the next one. Rows with equal doc_id follow each other
    by text. Rows without a doc_id are in no order: their next columns are null.
    """
    rows = docs.withColumn("bucket", F.shiftright("doc_id", BUCKET_BITS)).withColumn("edge", F.lit(0))
    known = rows.filter("doc_id is not null")
    sources = _before(known).select(F.col("bucket").alias("for_bucket"), F.col("source").alias("doc_id"))
    edges = known.join(sources, "doc_id").withColumn("bucket", F.col("for_bucket")).withColumn("edge", F.lit(1))
    window = Window.partitionBy("bucket").orderBy("edge", F.desc("doc_id"), F.desc("text"))
    both = known.unionByName(edges.select(known.columns))
    joined = both.select("*", *(F.lead(c).over(window).alias(f"next_{c}") for c in columns)).filter("edge = 0")
    lost = rows.filter("doc_id is null").select("*", *(F.lit(None).cast(dict(docs.dtypes)[c]).alias(f"next_{c}") for c in columns))
    return joined.unionByName(lost).drop("bucket", "edge")


def fingerprint_documents(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fingerprint, bins) of every row of ``docs`` (doc_id, text); null texts are empty."""
    rows = plain(docs, "doc_id", "text").select("doc_id", sketch(text_or_empty(), words).alias("bins"))
    return rows.select("doc_id", packed(F.col("bins")).alias("fingerprint"), "bins")


def edited_report(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Fingerprints of texts and of their edited texts, with their likeness.

    The last third of a text (code points, rounded down) gives way to the start of the next document's.
    A row without doc_id has no next document, loses its last third and has a null ``near_next``.
    """
    rows = plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", text_or_empty())
    paired = with_next(rows.withColumn("bins", sketch(F.col("text"), words)), "text", "bins")
    size = F.char_length("text")
    cut = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - cut), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut))
    made = paired.select("doc_id", size.cast("long").alias("n_chars"), edited.alias("edited"), "bins", "next_bins")
    made = made.withColumn("edited_bins", sketch(F.col("edited"), words))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        packed(F.col("bins")).alias("fingerprint"),
        packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        F.when(F.col("next_bins").isNotNull(), likeness(F.col("bins"), F.col("next_bins"))).alias("near_next"),
    )
