"""Exact order statistics and running totals without a single-task sort.

``percentile`` keeps every distinct value of a column in one buffer and a window
without partition keys sorts everything in one task. The functions here bracket ranks by
mergeable sketches and count inside the brackets, narrow down further where that
is not enough, or split by value ranges.
"""

from __future__ import annotations

import math
from collections.abc import Hashable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from riskmill.functions.durable import take_bounded

# Counted values that the driver takes inside the brackets of all columns.
SMALL_DISTINCT = 100_000
# Size of a quantile sketch (about 50 KB) and the rank error its brackets allow for, several times the usual one.
SKETCH, SKETCH_ERROR = 4096, 0.003
# Rows of one range of a running total, about.
ROWS_PER_RANGE = 1_000_000


# --- exact ranks -----------------------------------------------------------

def values_at_ranks(
    df: DataFrame,
    wanted: Mapping[Hashable, tuple[Column, int]],
    bins: int = 4096,
) -> dict[Hashable, object]:
    """Value at a 0-based rank for several numeric expressions at once.

    ``wanted`` maps a name to ``(expression, rank)``; nulls are not ranked. Each
    round counts the values per equal-width bin of the current bracket, and the
    bin that holds the rank, shrunk to its own smallest and largest value, is the
    next bracket. The table is only aggregated, never sorted or moved, and the
    driver sees one row per name and round. Ranks of one expression share the
    work for as long as they share the bracket.

    The expressions are cached for the rounds, since they may be the end of a
    long computation.
    """
    sources: dict[int, Column] = {id(expression): expression for expression, _ in wanted.values()}
    if not sources:
        return {}
    column_of = {key: f"v{i}" for i, key in enumerate(sources)}
    values = df.select(
        *[expression.alias(column_of[key]) for key, expression in sources.items()]
    ).persist()
    try:
        found, brackets = _first_brackets(values, column_of, wanted)
        while brackets:
            for name in [n for n, (_, lo, hi, _) in brackets.items() if lo == hi]:
                found[name] = brackets.pop(name)[1]
            if brackets:
                brackets = _narrow(values, brackets, bins)
        return found
    finally:
        values.unpersist()


def _finite(column: str) -> Column:
    value = F.col(column)
    return F.when(F.abs(value.cast("double")) < F.lit(math.inf), value)


def _first_brackets(values: DataFrame, column_of: Mapping[int, str], wanted: Mapping):
    """Smallest and largest finite value per column; ranks of infinities are settled."""
    first = values.agg(
        *[
            statistic
            for c in column_of.values()
            for statistic in (
                F.min(_finite(c)).alias(f"{c}_lo"),
                F.max(_finite(c)).alias(f"{c}_hi"),
                F.count(F.when(F.col(c) == F.lit(-math.inf), 1)).alias(f"{c}_below"),
                F.count(_finite(c)).alias(f"{c}_finite"),
                F.count(c).alias(f"{c}_all"),
            )
        ]
    ).first()
    found, brackets = {}, {}
    for name, (expression, rank) in wanted.items():
        c = column_of[id(expression)]
        inner = rank - first[f"{c}_below"]
        if not 0 <= rank < first[f"{c}_all"]:
            found[name] = None
        elif inner < 0:
            found[name] = -math.inf
        elif inner >= first[f"{c}_finite"]:
            found[name] = math.inf
        else:
            brackets[name] = (c, first[f"{c}_lo"], first[f"{c}_hi"], inner)
    return found, brackets


def _share(value: Column, lo, hi) -> Column:
    """Position of a value in its bracket, from 0 to 1; never decreasing in the value."""
    if isinstance(lo, int) and hi - lo < 2**62:
        return (value - F.lit(lo)).cast("double") / F.lit(float(hi - lo))
    if math.isfinite(float(hi) - float(lo)):
        return (value.cast("double") - F.lit(float(lo))) / F.lit(float(hi) - float(lo))
    # Halving first keeps the width of the widest bracket finite.
    return (value / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)


def _narrow(values: DataFrame, brackets: Mapping, bins: int) -> dict:
    """One round for all open names: the bin that holds the rank, per name."""
    groups: dict[tuple, dict[int, list]] = {}
    for name, (c, lo, hi, inner) in brackets.items():
        groups.setdefault((c, lo, hi), {}).setdefault(inner, []).append(name)

    cells = []
    for i, (c, lo, hi) in enumerate(groups):
        value = F.col(c)  # the bounds are finite, so infinities are outside
        cell = F.least((_share(value, lo, hi) * bins).cast("int"), F.lit(bins - 1))
        inside = (value >= F.lit(lo)) & (value <= F.lit(hi))
        cells.append(
            F.struct(
                F.lit(i).alias("item"), F.when(inside, cell).alias("cell"), value.alias("value")
            )
        )
    hits = F.filter(F.array(*cells), lambda entry: entry["cell"].isNotNull())
    ranks = F.element_at(
        F.array(*[F.array(*[F.lit(rank) for rank in sorted(ranks)]) for ranks in groups.values()]),
        F.col("item") + 1,
    )
    upto = Window.partitionBy("item").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    counted = (
        values.select(F.inline(hits))
        .groupBy("item", "cell")
        .agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .withColumn("upto", F.sum("n").over(upto))
        .withColumn("rank", F.explode(ranks))
        .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        .select("item", "rank", "lo", "hi", (F.col("upto") - F.col("n")).alias("before"))
    )
    by_item = list(groups.items())
    narrowed = {}
    for row in take_bounded(counted, len(brackets), "rank brackets"):
        (c, _, _), names_of = by_item[row["item"]]
        for name in names_of[row["rank"]]:
            narrowed[name] = (c, row["lo"], row["hi"], row["rank"] - row["before"])
    return narrowed


def exact_quantiles(
    df: DataFrame,
    columns: Mapping[Hashable, Column],
    probability: float = 0.5,
    small_distinct: int = SMALL_DISTINCT,
) -> dict[Hashable, float | None]:
    """Interpolated quantile of several double expressions; null where empty."""
    narrow = df.select(*[expression.alias(f"c{i}") for i, expression in enumerate(columns.values())])
    named = {name: F.col(f"c{i}") for i, name in enumerate(columns)}
    return quantiles_and_aggregates(narrow, named, [], probability, small_distinct)[0]


def quantiles_and_aggregates(
    df: DataFrame,
    columns: Mapping[Hashable, Column],
    aggregates: Sequence[Column],
    probability: float = 0.5,
    small_distinct: int = SMALL_DISTINCT,
) -> tuple[dict[Hashable, float | None], Row | None]:
    """``exact_quantiles`` and other aggregates that share its first pass.

    The first pass also makes a mergeable quantile sketch of every column. Its estimates around
    the wanted ranks are a bracket, and one counting pass over the values inside
    the brackets gives the exact values: two reads whatever the number of columns. A bracket
    that misses its rank, or holds more than ``small_distinct`` values, is narrowed down rank by rank.
    ``df`` should be a narrow projection: it is cached between the reads, since it may be the end of a long computation.
    """
    if not columns:
        return {}, df.agg(*aggregates).first() if aggregates else None
    df = df.persist()
    try:
        return _sketch_and_count(df, columns, aggregates, probability, small_distinct)
    finally:
        df.unpersist()


def _sketch_and_count(
    df: DataFrame, columns: Mapping[Hashable, Column], aggregates: Sequence[Column], probability: float, small_distinct: int
) -> tuple[dict[Hashable, float | None], Row]:
    sketched = df.agg(
        *aggregates,
        *[F.count(expression).alias(f"_n{i}") for i, expression in enumerate(columns.values())],
        *[
            F.kll_sketch_agg_double(expression.cast("double"), F.lit(SKETCH)).alias(f"_s{i}")
            for i, expression in enumerate(columns.values())
        ],
    )
    low, high = max(0.0, probability - SKETCH_ERROR), min(1.0, probability + SKETCH_ERROR)
    bounds = [
        F.when(F.col(f"_n{i}") > 0, F.kll_sketch_get_quantile_double(f"_s{i}", F.lit(at))).alias(f"_{side}{i}")
        for i in range(len(columns))
        for side, at in (("lo", low), ("hi", high))
    ]
    kept = [c for c in sketched.columns if not c.startswith("_s")]
    sizes = sketched.select(*kept, *bounds).first()

    result: dict[Hashable, float | None] = dict.fromkeys(columns)
    open_columns = {i: (name, e) for i, (name, e) in enumerate(columns.items()) if sizes[f"_n{i}"]}
    inside, below = _values_inside(df, open_columns, sizes, small_distinct)
    ranks = {}
    for i, (name, expression) in open_columns.items():
        position = probability * (sizes[f"_n{i}"] - 1)
        ends = (math.floor(position) - below.get(i, 0), math.ceil(position) - below.get(i, 0))
        found = None if inside is None else at_ranks(inside.get(i, []), ends)
        if found is None:
            ranks[name, "lower"] = (expression, math.floor(position))
            ranks[name, "upper"] = (expression, math.ceil(position))
        else:
            result[name] = between(*found, position)
    values = values_at_ranks(df, ranks)
    for i, (name, _) in open_columns.items():
        if (name, "lower") in ranks:
            position = probability * (sizes[f"_n{i}"] - 1)
            result[name] = between(float(values[name, "lower"]), float(values[name, "upper"]), position)
    return result, sizes


def between(low: float, high: float, position: float) -> float:
    weight = position - math.floor(position)
    return low if low == high else low * (1 - weight) + high * weight


def _values_inside(
    df: DataFrame, columns: Mapping[int, tuple], sizes: Row, most: int
) -> tuple[dict[int, list] | None, dict[int, int]]:
    """(value, rows) inside each column's bracket and rows below it, by one count; None if there are too many values."""
    cells = []
    for i, (_, expression) in columns.items():
        value = expression.cast("double")
        lo, hi = F.lit(sizes[f"_lo{i}"]), F.lit(sizes[f"_hi{i}"])
        kept = F.when(value >= lo, value)  # below the bracket: null
        cells.append(F.when(value <= hi, F.struct(F.lit(i).alias("item"), kept.alias("value"))))
    if not cells:
        return {}, {}
    counted = df.select(F.inline(F.array_compact(F.array(*cells)))).groupBy("item", "value").agg(F.count("*").alias("n"))
    rows = counted.take(most + 1)
    if len(rows) > most:
        return None, {}
    inside: dict[int, list] = {}
    below = {}
    for row in rows:
        if row["value"] is None:
            below[row["item"]] = row["n"]
        else:
            inside.setdefault(row["item"], []).append((row["value"], row["n"]))
    return {i: sorted(found) for i, found in inside.items()}, below


def at_ranks(values: Sequence[tuple], ranks: tuple[int, int]) -> tuple[float, float] | None:
    """Values at two 0-based ranks of sorted (value, rows); None if a rank is outside."""
    found, upto = [], 0
    for value, n in values:
        while len(found) < 2 and upto <= ranks[len(found)] < upto + n:
            found.append(value)
        upto += n
    return (found[0], found[1]) if len(found) == 2 else None


# --- running totals --------------------------------------------------------

def range_splits(
    df: DataFrame,
    value: str,
    ranges: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> list[float]:
    """Boundaries that cut a double column into ranges of about equal row count.

    ``ranges`` is taken from the row count where not given. The boundaries only
    balance the work, so approximate quantiles are enough: every result computed
    over the ranges is exact for any boundaries.
    """
    if ranges is None:
        ranges = math.ceil(df.count() / rows_per_range)
    if ranges <= 1:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    return sorted(set(df.stat.approxQuantile(value, shares, 1.0 / (4 * ranges))))


def running_totals(
    per_value: DataFrame,
    value: str,
    totals: Sequence[str],
    by: Sequence[str],
    splits: Sequence[float],
) -> DataFrame:
    """Add ``cum_<c>``: the total of ``c`` over all rows with value >= this one.

    ``per_value`` holds one row per value and group, so a value that covers most
    of the data is a single row here. Prefix sums in two levels: each range is summed on its own,
    and shifted by the totals of the ranges above it. Ranges are themselves put into about as many
    blocks as a block has ranges, so that their totals are prefix sums of the same kind:
    no task sees more than one range, the ranges of a block, or the blocks.
    """
    edges = [-math.inf, *(splits or [0.0]), math.inf]
    block = max(1, math.isqrt(len(splits) + 1))
    ranged = Bucketizer(splits=edges, inputCol=value, outputCol="_range").transform(per_value)
    ranged = ranged.withColumn("_block", F.floor(F.col("_range") / block))
    sums = ranged.groupBy(*by, "_block", "_range").agg(*[F.sum(c).alias(c) for c in totals])
    blocks = sums.groupBy(*by, "_block").agg(*[F.sum(c).alias(c) for c in totals])

    def above(keys: Sequence[str], place: str, c: str) -> Column:
        window = Window.partitionBy(*keys).orderBy(F.col(place).desc())
        return F.coalesce(F.sum(c).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    in_block = [above([*by, "_block"], "_range", c).alias(f"_in_{c}") for c in totals]
    of_blocks = [above(by or [F.lit(0)], "_block", c).alias(f"_of_{c}") for c in totals]
    shifts = sums.select(*by, "_block", "_range", *in_block).join(
        blocks.select(*by, "_block", *of_blocks), [*by, "_block"]
    )
    shifts = shifts.select(
        *by, "_range", *[(F.col(f"_in_{c}") + F.col(f"_of_{c}")).alias(f"_above_{c}") for c in totals]
    )
    inside = Window.partitionBy(*by, "_range").orderBy(F.col(value).desc())
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({f"_sum_{c}": F.sum(c).over(inside) for c in totals})
    return summed.join(shifts, [*by, "_range"]).select(
        *per_value.columns,
        *[(F.col(f"_sum_{c}") + F.col(f"_above_{c}")).alias(f"cum_{c}") for c in totals],
    )
