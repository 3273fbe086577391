"""Stratified splits and folds with exact sizes, without sorting the table.

A split is "the first k rows of each class in a random but fixed order". Instead
of ranking every row, the key of the k-th row is found: rows are counted per class
and key bucket, and only the bucket that holds the k-th row is ranked. Assigning
the rows is then a comparison with a handful of cut keys, so the table itself is
never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskmill.functions.durable import take_bounded
from riskmill.functions.hashing import BUCKET, LEVELS, ORDER, key_prefix, shuffle_key
from riskmill.operators.order_stats import values_at_ranks
from riskmill.spec import FOLDS, SEED, TEST_SIZE

MAX_CLASSES = 10_000
# Rows of a bucket that are ranked; larger ones are narrowed by further bits.
SMALL_BUCKET = 100_000
_STRATUM = "_stratum"
_ID = "_id"


def train_quotas(class_sizes: Mapping, test_size: float = TEST_SIZE) -> dict:
    """Training rows per class: proportional, rounded by largest remainder."""
    total = sum(class_sizes.values())
    n_train = total - math.ceil(test_size * total)
    exact = {label: size * n_train / total for label, size in class_sizes.items()}
    quotas = {label: math.floor(share) for label, share in exact.items()}
    short = n_train - sum(quotas.values())
    by_remainder = sorted(exact, key=lambda label: (quotas[label] - exact[label], str(label)))
    for label in by_remainder[:short]:
        quotas[label] += 1
    return quotas


def fold_quotas(class_sizes: Mapping, folds: int = FOLDS) -> dict:
    """Rows per class and fold: deal all rows, class after class, in turn."""
    quotas, dealt = {}, 0
    for label in sorted(class_sizes, key=str):
        size = class_sizes[label]
        quotas[label] = [
            (dealt + size - fold + folds - 1) // folds - (dealt - fold + folds - 1) // folds
            for fold in range(folds)
        ]
        dealt += size
    return quotas


def _keyed(df: DataFrame, label: str, row_id: str, seed: int, method: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).select(
        F.col(label).alias(_STRATUM),
        F.col(row_id).alias(_ID),
        shuffle_key(F.col(row_id), seed, method).alias(ORDER),
    )


def _narrowed(keyed: DataFrame, wanted: Sequence[tuple], level: int, method: str) -> list[tuple]:
    """For each (class, bucket, position in it) the bucket one level down: (class, position, bucket, position in it, rows).

    ``wanted`` is (class, position, bucket, inner); the bucket is null on the first level. Only rows of the wanted
    buckets are counted, and the driver sees one row per wanted position.
    """
    spark, kind = keyed.sparkSession, keyed.schema[_STRATUM].dataType.simpleString()
    key = keyed.schema[ORDER].dataType.simpleString()
    places = spark.createDataFrame(wanted, f"_class {kind}, position bigint, _parent {key}, inner bigint")
    rows = keyed.withColumn(BUCKET, key_prefix(F.col(ORDER), level, method))
    if level > 1:
        rows = rows.withColumn("_above", key_prefix(F.col(ORDER), level - 1, method))
        parents = places.select(F.col("_class").alias(_STRATUM), F.col("_parent").alias("_above")).distinct()
        rows = rows.join(F.broadcast(parents), [_STRATUM, "_above"], "left_semi")
    else:
        rows = rows.withColumn("_above", F.lit(None).cast(key))
    counts = rows.groupBy(_STRATUM, "_above", BUCKET).agg(F.count("*").alias("n"))
    upto = Window.partitionBy(_STRATUM, "_above").orderBy(BUCKET)
    summed = counts.withColumn("upto", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    same = (F.col("_class") == F.col(_STRATUM)) & F.col("_parent").eqNullSafe(F.col("_above"))
    met = summed.join(F.broadcast(places), same).where(
        (F.col("inner") <= F.col("upto")) & (F.col("inner") > F.col("upto") - F.col("n"))
    )
    found = met.select(
        _STRATUM, "position", BUCKET, (F.col("inner") - F.col("upto") + F.col("n")).alias("inner"), "n"
    )
    return [tuple(row) for row in take_bounded(found, len(wanted), "cut buckets")]


def _class_cuts(
    df: DataFrame, label: str, row_id: str, seed: int, method: str, positions_of
) -> DataFrame:
    """Keys of the rows at given 1-based positions of each class, as a local table.

    ``positions_of`` maps class sizes to the wanted positions per class. The
    result has one row per class: ``cuts``, the sorted keys, and ``skip``, the
    number of positions that lie before the first row. The bucket that holds a position is narrowed by
    further bits of the key until it has at most ``SMALL_BUCKET`` rows; only those are ranked.
    """
    keyed = _keyed(df, label, row_id, seed, method)
    spark = df.sparkSession
    kind = keyed.schema[_STRATUM].dataType.simpleString()
    sizes = {
        row[_STRATUM]: row["n"]
        for row in take_bounded(keyed.groupBy(_STRATUM).agg(F.count("*").alias("n")), MAX_CLASSES, "classes")
    }
    wanted = positions_of(sizes)
    inside = [
        (stratum, position)
        for stratum, positions in wanted.items()
        for position in set(positions)
        if 0 < position <= sizes[stratum]
    ]
    places = {(s, p): (s, p, None, p) for s, p in inside}
    level_of: dict[tuple, int] = {}
    for level in range(1, LEVELS + 1):
        narrowed = _narrowed(keyed, list(places.values()), level, method) if places else []
        for stratum, position, bucket, inner, n in narrowed:
            places[stratum, position] = (stratum, position, bucket, inner)
            level_of[stratum, position] = level
        if all(n <= SMALL_BUCKET for *_, n in narrowed):
            break

    # All places are on one level: a small bucket stays small when it is narrowed with the others.
    level = max(level_of.values(), default=1)
    key = keyed.schema[ORDER].dataType.simpleString()
    buckets = spark.createDataFrame(list(places.values()), f"{_STRATUM} {kind}, position bigint, {BUCKET} {key}, inner bigint")
    buckets = F.broadcast(buckets)  # one row per class and cut
    ranked = Window.partitionBy(_STRATUM, BUCKET).orderBy(ORDER, _ID)
    keys = take_bounded(
        keyed.withColumn(BUCKET, key_prefix(F.col(ORDER), level, method))
        .join(buckets.select(_STRATUM, BUCKET).distinct(), [_STRATUM, BUCKET], "left_semi")
        .withColumn("inner", F.row_number().over(ranked).cast("bigint"))
        .join(buckets, [_STRATUM, BUCKET, "inner"])
        .select(_STRATUM, "position", ORDER, _ID),
        len(inside),
        "cut keys",
    )
    found = {(row[_STRATUM], row["position"]): (row[ORDER], row[_ID]) for row in keys}
    rows = []
    for stratum, positions in wanted.items():
        cuts = [found[stratum, p] for p in sorted(positions) if (stratum, p) in found]
        rows.append((stratum, cuts, sum(1 for p in positions if p <= 0)))
    types = {c: keyed.schema[c].dataType.simpleString() for c in (ORDER, _ID)}
    table = spark.createDataFrame(
        rows,
        f"{_STRATUM} {kind}, _cuts array<struct<{ORDER}: {types[ORDER]}, {_ID}: {types[_ID]}>>, "
        "_skip int",
    )
    return F.broadcast(table)  # one row per class, at most MAX_CLASSES


def _passed_cuts(
    df: DataFrame, cuts: DataFrame, label: str, row_id: str, seed: int, method: str
) -> tuple[DataFrame, Column]:
    """The table with its class cuts, and the number of cuts that lie before a row."""
    joined = df.join(cuts, F.col(label) == F.col(_STRATUM), "left")
    key = F.struct(
        shuffle_key(F.col(row_id), seed, method).alias(ORDER), F.col(row_id).alias(_ID)
    )
    passed = F.size(F.filter("_cuts", lambda cut: cut < key)) + F.col("_skip")
    return joined, F.when(F.col("_cuts").isNotNull(), passed)


def stratified_split(
    df: DataFrame,
    label: str,
    row_id: str,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    method: str = "xxhash64",
    part: str = "part",
) -> DataFrame:
    """Add ``part``: "train" or "test", with exact sizes per class.

    Rows without a label get no part.
    """
    def positions(sizes):
        quotas = train_quotas(sizes, test_size)
        return {c: [quotas[c]] for c in sizes}

    cuts = _class_cuts(df, label, row_id, seed, method, positions)
    joined, passed = _passed_cuts(df, cuts, label, row_id, seed, method)
    name = F.when(passed == 0, F.lit("train")).when(passed > 0, F.lit("test"))
    return joined.withColumn(part, name).drop(_STRATUM, "_cuts", "_skip")


def stratified_folds(
    df: DataFrame,
    label: str,
    row_id: str,
    folds: int = FOLDS,
    seed: int = SEED,
    method: str = "xxhash64",
    fold: str = "fold",
) -> DataFrame:
    """Add ``fold``: 0 to ``folds - 1``, equal in size and in class shares."""
    def positions(sizes):
        quotas = fold_quotas(sizes, folds)
        return {
            c: [sum(quotas[c][: i + 1]) for i in range(folds - 1)] for c in sizes
        }

    cuts = _class_cuts(df, label, row_id, seed, method, positions)
    joined, passed = _passed_cuts(df, cuts, label, row_id, seed, method)
    return joined.withColumn(fold, passed.cast("int")).drop(_STRATUM, "_cuts", "_skip")


def labelled_part(df: DataFrame, split: DataFrame, row_id: str, target: str, part: str) -> DataFrame:
    """Labelled rows of one side of a saved split (semi join on the row id)."""
    ids = split.where(F.col("part") == part).select(row_id)
    return df.join(ids, row_id, "left_semi").where(F.col(target).isNotNull())


def prefix_sizes(n_train: int, shares: Sequence[float]) -> list[int]:
    """Distinct absolute sizes of the learning-curve prefixes."""
    return sorted({int(share * n_train) for share in shares if int(share * n_train) > 0})


def training_prefixes(
    df: DataFrame, fold: str, row_id: str, shares: Sequence[float], folds: int = FOLDS
) -> dict[tuple[int, int], object]:
    """Last row id of the first n training rows, per (fold, n).

    The rows of a prefix are then ``fold != f and row_id <= cut``. Ids must be
    unique and numeric.
    """
    sizes = {
        row[fold]: row["count"] for row in take_bounded(df.groupBy(fold).count(), folds, "folds")
    }
    total = sum(sizes.values())
    ids = {f: F.when(F.col(fold) != f, F.col(row_id)) for f in range(folds)}
    wanted = {
        (f, n): (ids[f], min(n, total - sizes.get(f, 0)) - 1)
        for f in range(folds)
        for n in prefix_sizes(total - sizes.get(0, 0), shares)
    }
    return values_at_ranks(df, wanted)


def prefix_counts(
    df: DataFrame, fold: str, row_id: str, label: str, cuts: Mapping[tuple[int, int], object]
) -> DataFrame:
    """Rows, positives and last id of every training prefix ``(fold, n)``.

    All cuts together divide the ids into segments. The table is aggregated once
    by its own fold and segment, and each prefix adds up the segments below its
    cut; a row is not repeated for the prefixes it belongs to.
    """
    edges = sorted(set(cuts.values()))
    inside = F.filter(F.array(*[F.lit(edge) for edge in edges]), lambda e: e < F.col(row_id))
    segments = (
        df.groupBy(F.col(fold).alias("own"), F.size(inside).alias("segment"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col(label).cast("bigint")).alias("positives"),
            F.max(row_id).alias("last_id"),
        )
    )
    prefixes = F.array(
        *[
            F.struct(
                F.lit(f).alias("fold"),
                F.lit(size).cast("bigint").alias("train_size"),
                F.lit(edges.index(cut)).alias("upto"),
            )
            for (f, size), cut in cuts.items()
        ]
    )
    matching = F.filter(
        prefixes, lambda p: (p["fold"] != F.col("own")) & (F.col("segment") <= p["upto"])
    )
    return (
        segments.select("n", "positives", "last_id", F.inline(matching))
        .groupBy("fold", "train_size")
        .agg(
            F.sum("n").alias("n"),
            F.sum("positives").alias("positives"),
            F.max("last_id").alias("last_id"),
        )
    )
