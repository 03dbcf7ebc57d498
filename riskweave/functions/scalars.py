"""Scalar expressions used by the feature, banding and reporting operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from riskweave.functions import fixed


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient; NULL for a zero denominator, also in ANSI mode."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), digits)


def years(days: Column) -> Column:
    return F.round(F.abs(days) / F.lit(fixed.DAYS_PER_YEAR), 1)


def recode(value: Column, mapping: Mapping, default) -> Column:
    """Look a code up in a small literal mapping; unknown and NULL codes get the default."""
    result = None
    for code, target in mapping.items():
        hit = value == F.lit(code)
        result = F.when(hit, F.lit(target)) if result is None else result.when(hit, F.lit(target))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def clip(value: Column, low: float, high: float) -> Column:
    """Keep a value inside [low, high]; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def below(value: Column, cuts: Sequence[tuple[float, str]], last: str) -> Column:
    """Label of the first cut the value lies strictly under."""
    result = None
    for cut, label in cuts:
        hit = value < F.lit(cut)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return result.otherwise(F.lit(last))


def above(value: Column, cuts: Sequence[tuple[float, str]], last: str) -> Column:
    """Label of the first cut the value lies strictly over."""
    result = None
    for cut, label in cuts:
        hit = value > F.lit(cut)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return result.otherwise(F.lit(last))


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the column type can hold one."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def fixed_text(value: Column, digits: int) -> Column:
    """Fixed-point text, rounded on the exact binary value as C, Python and JavaScript do.

    ``format_string`` rounds the shortest decimal form instead, so 47.15 would give 47.2. The
    fraction is scaled as a 60-bit integer in two halves; ties go to the even digit.
    """
    size = F.abs(value)
    whole = F.floor(size).cast("long")
    bits = ((size - whole) * F.lit(2.0**60)).cast("long")
    low_mask = F.lit(2**30 - 1)
    low = bits.bitwiseAND(low_mask) * 10**digits
    high = F.shiftright(bits, 30) * 10**digits + F.shiftright(low, 30)
    digit = F.shiftright(high, 30)
    rest = F.shiftleft(high.bitwiseAND(low_mask), 30).bitwiseOR(low.bitwiseAND(low_mask))
    half = F.lit(2**59)
    up = (rest > half) | ((rest == half) & (digit % 2 == 1))
    units = whole * (10**digits) + digit + up.cast("long")
    body = F.concat(
        F.floor(units / 10**digits).cast("long").cast("string"),
        F.lit("."),
        F.lpad((units % 10**digits).cast("string"), digits, "0"),
    )
    return F.when(value < 0, F.concat(F.lit("-"), body)).otherwise(body)


def percent_text(probability: Column, digits: int = 1) -> Column:
    return F.concat(fixed_text(probability * 100, digits), F.lit("%"))


def prefix(value: Column, separator: str) -> Column:
    """Everything before the first separator."""
    return F.substring_index(value, separator, 1)


def _digest(digits: int, parts: tuple[Column, ...]) -> Column:
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def stable_hash(*parts: Column) -> Column:
    """Non-negative 52-bit number from the parts: exact in a double as well."""
    return _digest(13, parts)


def stable_id(*parts: Column) -> Column:
    """Non-negative 60-bit row id from the parts of a natural key."""
    return _digest(15, parts)


def uniform_draw(*parts: Column) -> Column:
    """Reproducible draw from [0, 1), independent of how rows are partitioned."""
    return F.pmod(stable_hash(*parts), F.lit(1_000_000)) / F.lit(1_000_000.0)
