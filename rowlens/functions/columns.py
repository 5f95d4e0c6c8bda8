"""Column expressions shared by the operators. All of them stay inside Spark's codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bounds (exclusive) of the age bands 1 to 10; band 11 is open.
AGE_BOUNDS = (6, 11, 16, 21, 26, 36, 46, 56, 66, 76)


def name(text: str) -> Column:
    """A column by its exact name, which may hold dots, dashes or brackets."""
    return F.col("`" + text.replace("`", "``") + "`")


def equals(column: str, value: object) -> Column:
    """Equality with one class of a column: by number for a numeric value, else by text."""
    if isinstance(value, (int, float)):
        return name(column).cast("double") == F.lit(float(value))
    return name(column).cast("string") == F.lit(str(value))


def blank(column: Column, dtype: T.DataType, sentinel: str) -> Column:
    """Null where ``column`` holds the code for "missing", compared in the column's own type."""
    if isinstance(dtype, T.StringType):
        return F.nullif(column, F.lit(sentinel))
    if isinstance(dtype, T.NumericType):
        try:
            code = float(sentinel)
        except ValueError:  # a number is never such a text
            return column
        return F.nullif(column, F.lit(code).cast(dtype))
    return column


def parse_date(text: Column, pattern: str) -> Column:
    """A date, or null where the text is no valid date."""
    return F.try_to_date(text, pattern)


def parse_epoch(date_text: Column, time_text: Column, date_pattern: str, time_pattern: str) -> Column:
    """Seconds since 1970 of a date text and a time text; null where either is missing or invalid.

    The wall clock is read in the session time zone, which our sessions fix to UTC.
    """
    day = F.date_format(parse_date(date_text, date_pattern), "yyyy-MM-dd")
    moment = F.try_to_timestamp(F.concat(day, F.lit(" "), time_text), F.lit(f"yyyy-MM-dd {time_pattern}"))
    return F.unix_timestamp(moment)


def band(value: Column, upper_bounds: Sequence[float]) -> Column:
    """1 for values below the first bound, 2 below the second, ..., n+1 from the last bound on."""
    chain = F.when(value.isNull(), None)
    for code, bound in enumerate(upper_bounds, start=1):
        chain = chain.when(value < F.lit(bound), code)
    return chain.otherwise(len(upper_bounds) + 1).cast("int")


def recode(value: Column, labels: Mapping[str, str]) -> Column:
    """The label of a code; a code without a label and null pass through."""
    if not labels:
        return value
    pairs = list(labels.items())
    chain = F.when(value == F.lit(pairs[0][0]), F.lit(pairs[0][1]))
    for code, label in pairs[1:]:
        chain = chain.when(value == F.lit(code), F.lit(label))
    return chain.otherwise(value)


def x_log2_x(x: Column) -> Column:
    """x times log2(x), which is 0 at 0."""
    x = x.cast("double")
    return F.when(x > 0, x * F.log2(x)).otherwise(F.lit(0.0))


def unit_hash(seed: int, keys: Sequence[Column]) -> Column:
    """A number in [0, 1) that depends on the seed and the key only, not on the partitioning; a null is a value in its place."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(key.cast("string"), F.lit("\x00")) for key in keys)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def distance(columns: Sequence[Column], centre: Sequence[float]) -> Column:
    """Euclidean distance of a point held in plain columns to a fixed centre."""
    gaps = [column - F.lit(float(at)) for column, at in zip(columns, centre, strict=True)]
    return F.sqrt(reduce(lambda total, square: total + square, [gap * gap for gap in gaps]))


def array_distance(point: Column, centre: Column) -> Column:
    """Euclidean distance of two arrays of doubles of the same length."""
    gaps = F.zip_with(point, centre, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap))


def both(conditions: Sequence[Column]) -> Column:
    """All conditions at once, as a conjunction that Catalyst can split and push down."""
    return reduce(lambda left, right: left & right, conditions)


def ratio(above: Column, below: Column) -> Column:
    """A quotient of doubles; null where the divisor is 0."""
    return F.try_divide(above.cast("double"), below.cast("double"))
