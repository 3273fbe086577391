"""Exact duplicates: a two-pass Bloom filter finds the texts that may repeat, only those meet.

The first pass counts how often each slot of the filter is hit, the second looks up every
text's slots. A text with a slot that no other row hits is surely alone and passes straight
through; the rest, true repeats and a few false alarms, are grouped by SHA-256. The filter
only saves work: results do not depend on its size.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, functions as F

from riskmill.llm.common import join_sized, materialize, plain, text_or_empty, unused

#: Slots of the filter for each row and slots that a row hits.
BITS_PER_ROW, HASHES = 16, 2
#: Slots of one slice of the filter, the most that is broadcast at once (32 MB); a larger filter is probed slice by slice.
MAX_BITS = 1 << 28
#: Slots of one bitmap of Spark's bitmap functions.
BITMAP = 32768


def normalised(text: Column) -> Column:
    """Lower case for A-Z alone."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_digest(name: str = "text") -> Column:
    """Lower-case hex SHA-256 of the normalised text, null as empty."""
    return F.sha2(normalised(text_or_empty(name)).cast("binary"), 256)


def _slots(digest: Column, slices: int, bits: int) -> Column:
    """Structs (slice, bucket, bit) of the slots of a digest, all in the slice of the digest."""
    own = F.pmod(F.xxhash64(digest, F.lit(-1)), F.lit(slices)).cast("int")
    at = [F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(bits)) for i in range(HASHES)]
    return F.array(*(F.struct(own.alias("slice"), (a / BITMAP).cast("int").alias("bucket"), (a % BITMAP).cast("int").alias("bit")) for a in at))


def _is_set(bitmap: Column, bit: Column) -> Column:
    """Whether a bitmap (null: empty) has this bit, in the layout of ``bitmap_construct_agg``."""
    byte = F.conv(F.hex(F.substring(bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    shifted = F.call_function("shiftright", byte, (bit % 8).cast("int"))
    return F.coalesce(shifted.bitwiseAND(F.lit(1)) == 1, F.lit(False))


class Repeats:
    """The filter of all digests of a table that may occur more than once."""

    def __init__(self, digests: DataFrame, name: str):
        """``digests`` must be a written table; ``name`` is its digest column."""
        rows = digests.count()
        self.slices = max(1, math.ceil(rows * BITS_PER_ROW / MAX_BITS))
        self.bits = min(MAX_BITS, BITMAP * max(1, math.ceil(rows * BITS_PER_ROW / self.slices / BITMAP)))
        hit = digests.select(F.explode(_slots(F.col(name), self.slices, self.bits)).alias("s")).select("s.*")
        hit = hit.groupBy("slice", "bucket", "bit").agg(F.count("*").alias("n")).filter("n > 1")
        self.table = materialize(hit.groupBy("slice", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")), "filter")

    def split(self, rows: DataFrame, digest: Column) -> tuple[DataFrame, DataFrame]:
        """``rows`` that are surely alone and rows that may repeat, without a shuffle; columns stay."""
        alone, maybe = [], []
        names = unused(rows, 1 + 2 * HASHES)
        keyed = rows.withColumn(names[0], _slots(digest, self.slices, self.bits))
        for part in range(self.slices):
            bitmaps = self.table.filter(F.col("slice") == part)
            met = keyed.filter(F.col(names[0])[0]["slice"] == part) if self.slices > 1 else keyed
            found = F.lit(True)
            for i in range(HASHES):
                key, bitmap = names[1 + 2 * i : 3 + 2 * i]
                side = F.broadcast(bitmaps.select(F.col("bucket").alias(key), F.col("bitmap").alias(bitmap)))
                met = met.join(side, F.col(names[0])[i]["bucket"] == F.col(key), "left")
                found = found & _is_set(F.col(bitmap), F.col(names[0])[i]["bit"])
            alone.append(met.filter(~found).drop(*names))
            maybe.append(met.filter(found).drop(*names))
        return _union(alone), _union(maybe)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def find_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs`` (doc_id, text).

    Texts are equal when identical after lower-casing A-Z; null is empty. ``keep_id`` is the
    largest doc_id of the equal texts, a null id is smaller than any. Exactly one row of
    a group is kept: of repeated rows with the largest id, any one. An empty table gives an
    empty table; other columns take no part.
    """
    digests = plain(docs, "doc_id", "text").select("doc_id", text_digest().alias("sha"), F.monotonically_increasing_id().alias("row"))
    digests = materialize(digests, "digests")
    alone, maybe = Repeats(digests, "sha").split(digests, F.col("sha"))
    maybe = materialize(maybe, "maybe")
    groups = maybe.groupBy("sha").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
    groups = materialize(groups.select("sha", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "group_size"), "groups")
    single = alone.withColumns({"keep_id": F.col("doc_id"), "keep_row": F.col("row"), "group_size": F.lit(1).cast("long")})
    whole = single.unionByName(join_sized(maybe, groups, ["sha"], "group_size"))
    return whole.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, one row of each group of equal texts: the one with the largest doc_id.

    Whole rows only meet where the filter says that their text may repeat.
    """
    name = unused(docs, 1)[0]
    digests = materialize(docs.select(text_digest().alias("sha")), "digests")
    alone, maybe = Repeats(digests, "sha").split(docs, text_digest())
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    # A null id would be passed over, so it takes part as a struct, smaller than any other.
    kept = maybe.groupBy(text_digest().alias(name)).agg(F.max_by(row, F.struct("doc_id")).alias("row")).select("row.*")
    return alone.unionByName(kept)


def copies_sql() -> str:
    """The same rows for DuckDB."""
    return f"""
    with d as (select doc_id, sha256(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')) as text_sha256
               from documents),
    g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from d group by text_sha256)
    select d.doc_id, keep_id, group_size, d.doc_id = keep_id as kept, d.text_sha256 from d join g using (text_sha256)"""
