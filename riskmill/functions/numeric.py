"""Numeric column expressions: tolerant casts, scale repair, safe arithmetic.

Every function takes and returns a ``Column``, so it runs inside the JVM and
fuses with whatever projection or aggregate uses it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text accepted as a number: an optional sign, digits with an optional point and
# exponent, or the words for infinity. Spark's own cast also takes a trailing
# type letter ("1.0d"), which is not a number in a data file.
_NUMBER_TEXT = (
    r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
)


def missing_if_nan(value: Column) -> Column:
    """Fold NaN into null, so that one missing value exists downstream."""
    return F.nanvl(value, F.lit(None).cast("double"))


def text_to_double(text: Column) -> Column:
    """Tolerant cast of text: blank or non-numeric text becomes null."""
    return F.when(text.rlike(_NUMBER_TEXT), missing_if_nan(text.try_cast("double")))


def to_double(value: Column, data_type: str = "double") -> Column:
    """Numeric value of a column; text is cast tolerantly, NaN becomes null."""
    if data_type == "string":
        return text_to_double(value)
    return missing_if_nan(value.cast("double"))


def column_as_double(df, name: str) -> Column:
    """``to_double`` for a column of ``df``, looking its type up in the schema."""
    return to_double(F.col(name), df.schema[name].dataType.simpleString())


def is_out_of_scale(value: Column, max_valid: float) -> Column:
    """True for a present value whose magnitude exceeds ``max_valid``."""
    return F.coalesce(F.abs(value) > F.lit(float(max_valid)), F.lit(False))


def repair_scale(
    value: Column, max_valid: float, base: float = 10.0, max_steps: int = 64
) -> Column:
    """Undo a lost decimal point: divide by ``base`` until the value is in scale.

    The divisions are applied one after another, because a single division by a
    power of ``base`` rounds differently in the last bit. The logarithm only
    bounds the number of steps; whether a step divides is decided on the value.
    """
    limit, divisor = F.lit(float(max_valid)), F.lit(float(base))
    exponent = F.log(F.abs(value) / limit) / F.log(divisor)
    steps = F.least(F.ceil(F.least(exponent, F.lit(float(max_steps)))) + 1, F.lit(max_steps))
    stepped = F.aggregate(
        F.sequence(F.lit(1), steps),
        value,
        lambda acc, _: F.when(F.abs(acc) > limit, acc / divisor).otherwise(acc),
    )
    return F.when(F.abs(value) > limit, stepped).otherwise(value)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, or 0 for a zero denominator or missing side."""
    ratio = numerator / F.nullif(denominator, F.lit(0.0))
    return F.coalesce(missing_if_nan(ratio), F.lit(0.0))


def shortfall(done: Column, planned: Column) -> Column:
    """``planned - done`` where positive, else 0; a missing side gives 0."""
    return F.greatest(planned - done, F.lit(0.0))


def is_whole(value: Column) -> Column:
    return F.floor(value).cast("double") == value


def count_where(condition: Column) -> Column:
    """Number of rows for which ``condition`` is true."""
    return F.count(F.when(condition, F.lit(1)))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Ratio of two counts, 0 when there is nothing to divide by."""
    top, bottom = numerator.cast("double"), denominator.cast("double")
    return F.coalesce(top / F.nullif(bottom, F.lit(0.0)), F.lit(0.0))


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    top, bottom = numerator.cast("double"), denominator.cast("double")
    return top / F.nullif(bottom, F.lit(0.0))
