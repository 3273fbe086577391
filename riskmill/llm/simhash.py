"""SimHash fingerprints and near-duplicates by pigeonhole blocks.

64 bits over word triples, linked at two or fewer differing bits. The bits are cut into five
blocks; two flips leave three of them untouched, so pairs that agree on three blocks are
joined and their Hamming distance verified: exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from riskmill.llm.common import join_sized, materialize, plain, with_row_key
from riskmill.llm.components import components

SEED = 42
WIDTHS = (13, 13, 13, 13, 12)
#: Fingerprints in one block up to which all pairs are compared at once; beyond, see the stars of ``link_fingerprints``.
PAIRED = 32
#: Shingles whose bits are unpacked at once.
STEP = 1 << 15


def shingle_hashes(data: bytes, words: int) -> np.ndarray:
    """XXH64 of the space-joined word shingles, repeats included; fewer words: one of all."""
    parts = data.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())
    return np.fromiter((digest(joined[s:e], SEED) for s, e in pairs), np.uint64, len(parts) - words + 1)


def fingerprint(data: bytes, words: int = 3) -> int:
    """64 bits, each set if it is set in over half of the shingle hashes; 0 without words."""
    hashes = shingle_hashes(data, words)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), STEP):
        raw = hashes[at : at + STEP].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = counts * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and fp, the fingerprint as a signed long. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(x.as_py() or b"", words) for x in batch.column(len(keep))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(marks.view(np.int64))], [*keep, "fp"])

    kinds = dict(docs.dtypes)
    ddl = ", ".join(f"{c} {kinds[c]}" for c in keep)
    return plain(docs, *keep, "text").withColumn("text", F.col("text").cast("binary")).mapInArrow(run, f"{ddl}, fp bigint")


def _masks() -> list[int]:
    """Ten masks: each keeps three of the five blocks. Two flips touch two blocks at most."""
    starts = np.concatenate(([0], np.cumsum(WIDTHS)))
    blocks = [((1 << w) - 1) << int(s) for w, s in zip(WIDTHS, starts)]
    return [sum(chosen) for chosen in combinations(blocks, 3)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def link_fingerprints(nodes: DataFrame, distance: int = 2) -> DataFrame:
    """Links (a, b) among distinct 64-bit fingerprints ``fp`` at ``distance`` bits or fewer.

    The links have the components of the graph of all close pairs. Fingerprints that
    share three of five blocks meet; blocks of up to ``PAIRED`` fingerprints compare all
    pairs. In fuller blocks every fingerprint also goes to each value one bit away: two
    at distance two or less share such a value, and all that share one are at most two
    apart, so a link to the smallest of them replaces their pairs.
    """
    if distance != 2:
        raise ValueError("the five blocks are made for a distance of two")
    masks = _masks()
    keyed = nodes.select(
        "fp",
        F.explode(
            F.array(*(F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                      for i, m in enumerate(masks)))
        ).alias("k"),
    ).select("fp", "k.part", "k.key")
    full = keyed.groupBy("part", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = materialize(keyed.join(full, ["part", "key"]), "blocks")
    close = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance
    few = met.filter(F.col("n") <= PAIRED).drop("n")
    other = few.withColumnRenamed("fp", "b")
    pairs = few.withColumnRenamed("fp", "a").join(other, ["part", "key"]).filter(F.col("a") < F.col("b"))
    pairs = pairs.filter(close("a", "b")).select("a", "b")
    dense = met.filter(F.col("n") > PAIRED).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << i)) for i in range(64)))
    near = dense.select("fp", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("fp")))).alias("at"))
    low = near.withColumn("a", F.min("fp").over(Window.partitionBy("at")))
    star = low.filter(F.col("a") < F.col("fp")).select("a", F.col("fp").alias("b")).filter(close("a", "b"))
    return pairs.union(star).distinct()


def fingerprint_roots(marks: DataFrame) -> DataFrame:
    """(fp, root, first, size) for every different fp of the written table ``marks`` (doc_id, fp): a fingerprint of its
    component, the smallest doc_id and the number of rows with it."""
    nodes = materialize(marks.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("size")), "nodes")
    roots = components(link_fingerprints(nodes)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first", "size")
    return materialize(rooted, "rooted")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    Null or wordless texts have fingerprint zero and link like any other. Equal
    fingerprints are one node, so copies never meet as pairs. Repeated rows stay; an
    empty table gives an empty table; a null doc_id never becomes a component id unless
    its component has no other.
    """
    marks = materialize(fingerprints(docs), "fingerprints")
    rooted = fingerprint_roots(marks)
    lowest = rooted.filter("root <> fp").groupBy("root").agg(F.min("first").alias("low"))
    named = rooted.join(lowest, "root", "left").select(
        "fp", F.least("first", "low").alias("own"), F.col("root"), "low"
    )
    heads = named.filter("fp = root").select("root", F.col("own").alias("component_id"))
    labels = materialize(rooted.select("fp", "root", "size").join(heads, "root").select("fp", "component_id", "size"), "labels")
    return join_sized(marks, labels, ["fp"], "size").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words: int = 3) -> DataFrame:
    """All columns of ``docs``, one row of each group of ``simhash_groups``: the one with the smallest doc_id.

    Rows are told apart by a key of their own, so repeated doc_ids leave one row of a group, and a row
    without doc_id stays if its group has no other.
    """
    keyed, key = with_row_key(docs, "rows")
    rows = keyed.select(F.col(key).alias("row"), "doc_id", "text")
    marks = materialize(fingerprints(rows, words, ("row", "doc_id")), "fingerprints")
    named = join_sized(marks, fingerprint_roots(marks), ["fp"], "size")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    heads = named.groupBy("root").agg(first.alias("head")).select(F.col("head.row").alias(key))
    return keyed.join(heads, key, "left_semi").drop(key)
