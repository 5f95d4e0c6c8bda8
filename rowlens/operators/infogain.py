"""Entropy, information gain and gain ratio of many attributes in one job.

Rows are reduced to counts per (attribute, value) first, with partial aggregation,
so a value that a third of all rows share is one row afterwards. With N rows, T of
them positive, and counts n, t per value, everything follows from sums of x*log2(x):

    H(label)  = log2 N - (T log2 T + F log2 F) / N
    H(label | attribute) = sum(n log2 n - t log2 t - f log2 f) / N
    split information    = log2 N - sum(n log2 n) / N

Rows in which the attribute or the label is null do not count for that attribute.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowlens.functions.columns import equals, name, ratio, x_log2_x
from rowlens.operators.ordered import in_blocks, running_totals
from rowlens.operators.profile import category_counts


def _whole(df: DataFrame, column: str) -> Column:
    """An order-preserving bigint of an integer, date or time column."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.DateType):
        return F.unix_date(name(column)).cast("bigint")
    if isinstance(dtype, T.TimestampNTZType):
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", start, name(column))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(name(column))
    return name(column).cast("bigint")


#: The column that holds a value: exact integers and times, other numbers, or text.
_KINDS = {"whole": "bigint", "real": "double", "text": "string"}


def _kind(df: DataFrame, column: str, ordered: bool) -> str:
    if not ordered:
        return "text"
    whole = isinstance(df.schema[column].dataType, (T.IntegralType, T.DatetimeType))
    return "whole" if whole else "real"


def _cell(df: DataFrame, column: str, kind: str) -> Column:
    if kind == "whole":
        return _whole(df, column)
    return name(column).cast(_KINDS[kind])


def label_counts(
    df: DataFrame,
    label: str,
    positive: object,
    nominal: Sequence[str] = (),
    ordered: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Rows n and positives t per attribute and value, for all attributes in one scan.

    ``attribute`` is the position in (*nominal, *ordered). The value is in the one of
    ``whole``, ``real`` and ``text`` that fits its type, so no digit is lost; of these
    only the columns in use exist. Rows without a value stay as one row of n = 0, so
    that an attribute without any value is still listed.
    """
    columns = [(c, _kind(df, c, i >= len(nominal))) for i, c in enumerate((*nominal, *ordered))]
    used = [kind for kind in _KINDS if any(k == kind for _, k in columns)]
    cells = []
    for i, (c, kind) in enumerate(columns):
        cells.append(F.lit(i))
        cells += [_cell(df, c, k) if k == kind else F.lit(None).cast(_KINDS[k]) for k in used]
    kept = [name(weight).alias("_w")] if weight else []
    long = df.filter(name(label).isNotNull()).select(
        equals(label, positive).alias("_y"), *kept, F.stack(F.lit(len(columns)), *cells).alias("attribute", *used)
    )
    present = reduce(lambda left, right: left | right, [F.col(k).isNotNull() for k in used])
    each = F.col("_w") if weight else F.lit(1)
    return long.groupBy("attribute", *used).agg(
        F.sum(F.when(present, each).otherwise(0)).cast("bigint").alias("n"),
        F.sum(F.when(present & F.col("_y"), each).otherwise(0)).cast("bigint").alias("t"),
    )


def _named(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Positions back to attribute names."""
    names = F.array(*(F.lit(c) for c in columns))
    return df.withColumn("attribute", names[F.col("attribute")])


def label_counts_by_value(
    df: DataFrame, label: str, positive: object, columns: Sequence[str], weight: str | None = None
) -> DataFrame:
    """(attribute, value, n, n_true, n_false) per value of each column."""
    counts = label_counts(df, label, positive, nominal=columns, weight=weight).filter("n > 0")
    return _named(counts, columns).select(
        "attribute", F.col("text").alias("value"), "n", F.col("t").alias("n_true"), (F.col("n") - F.col("t")).alias("n_false")
    )


def entropy(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Shannon entropy in bits of each column, as (attribute, n, entropy); nulls do not count."""
    counts = category_counts(df, columns, weight).filter(F.col("value").isNotNull())
    sums = counts.groupBy("attribute").agg(
        F.sum("n").alias("n"), F.sum(x_log2_x(F.col("n"))).alias("s"), F.count(F.lit(1)).alias("d")
    )
    bits = F.log2(F.col("n").cast("double")) - F.col("s") / F.col("n")
    return sums.select("attribute", "n", F.when(F.col("d") == 1, F.lit(0.0)).otherwise(bits).alias("entropy"))


def _binary_entropy(t: Column, n: Column) -> Column:
    """Entropy in bits of t positives among n rows."""
    p = ratio(t, n)
    return -(x_log2_x(p) + x_log2_x(1 - p))


def _nominal_scores(counts: DataFrame) -> DataFrame:
    n, t, f = F.col("n"), F.col("t"), F.col("n") - F.col("t")
    sums = counts.groupBy("attribute").agg(
        F.sum("n").alias("total"),
        F.sum("t").alias("total_t"),
        F.sum(x_log2_x(n)).alias("s_n"),
        F.sum(x_log2_x(n) - x_log2_x(t) - x_log2_x(f)).alias("s_cond"),
        F.count_if(n > 0).alias("d"),
    )
    total = F.col("total").cast("double")
    label_sum = x_log2_x(F.col("total_t")) + x_log2_x(F.col("total") - F.col("total_t"))
    label_bits = F.log2(total) - ratio(label_sum, total)
    conditional = ratio(F.col("s_cond"), total)
    split = F.when(F.col("d") > 1, F.log2(total) - ratio(F.col("s_n"), total))
    gain = label_bits - conditional
    return sums.select(
        "attribute",
        label_bits.alias("label_entropy"),
        conditional.alias("conditional_entropy"),
        gain.alias("information_gain"),
        split.alias("intrinsic_value"),
        ratio(gain, split).alias("gain_ratio"),
    )


def gain_ratio_nominal(
    df: DataFrame, label: str, positive: object, columns: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Conditional entropy, information gain, split information and gain ratio of nominal columns."""
    return _named(_nominal_scores(label_counts(df, label, positive, nominal=columns, weight=weight)), columns)


def cumulative_counts(
    df: DataFrame, label: str, positive: object, columns: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Counts per ordered value with their running sums: n, t, cum_n, cum_t, all_n, all_t.

    The value is in ``whole`` (integers, dates, times) or ``real``.
    """
    running = _running(_blocks(label_counts(df, label, positive, ordered=columns, weight=weight)))
    filled = [F.col(k) if k in running.columns else F.lit(None).cast(_KINDS[k]).alias(k) for k in ("whole", "real")]
    sums = ("n", "t", "cum_n", "cum_t", "all_n", "all_t")
    return _named(running.filter("n > 0").select("attribute", *filled, *sums), columns)


def _order(counts: DataFrame) -> list[Column]:
    return [F.col(k) for k in _KINDS if k in counts.columns]


def _blocks(counts: DataFrame) -> DataFrame:
    return in_blocks(counts, ["attribute"], _order(counts))


def _running(blocks: DataFrame) -> DataFrame:
    return running_totals(blocks, ["attribute"], _order(blocks), ["n", "t"])


def _best_threshold(blocks: DataFrame) -> DataFrame:
    return _thresholds(_running(blocks)).groupBy("attribute").agg(F.max("gain_ratio").alias("gain_ratio"))


def _thresholds(running: DataFrame) -> DataFrame:
    """Gain ratio of each split "up to this value" against "above it"; null at the last value."""
    cn, ct, n, t = (F.col(c) for c in ("cum_n", "cum_t", "all_n", "all_t"))
    share = ratio(cn, n)
    inside = share * _binary_entropy(ct, cn) + (1 - share) * _binary_entropy(t - ct, n - cn)
    gain = _binary_entropy(t, n) - inside
    return running.withColumn("gain_ratio", F.when((cn > 0) & (cn < n), ratio(gain, _binary_entropy(cn, n))))


def gain_ratio_threshold(
    df: DataFrame, label: str, positive: object, columns: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Best gain ratio of each ordered column over all thresholds; null for a single value."""
    counts = label_counts(df, label, positive, ordered=columns, weight=weight)
    return _named(_best_threshold(_blocks(counts)), columns)


def gain_ratio_table(
    df: DataFrame,
    label: str,
    positive: object,
    nominal: Sequence[str] = (),
    ordered: Sequence[str] = (),
    digits: int | None = 4,
    weight: str | None = None,
) -> DataFrame:
    """Attributes ranked by gain ratio, best first.

    One scan counts all attributes; the counts are kept once and feed both the
    nominal sums and the threshold search.
    """
    counts = label_counts(df, label, positive, nominal, ordered, weight)
    if not ordered:
        scores = _nominal_scores(counts).select("attribute", "gain_ratio")
    else:
        blocks = _blocks(counts)
        is_ordered = F.col("attribute") >= len(nominal)
        scores = _best_threshold(blocks.filter(is_ordered))
        if nominal:
            scores = scores.unionByName(_nominal_scores(blocks.filter(~is_ordered)).select("attribute", "gain_ratio"))
    scores = _named(scores, [*nominal, *ordered])
    if digits is not None:
        scores = scores.withColumn("gain_ratio", F.round("gain_ratio", digits))
    return scores.orderBy(F.col("gain_ratio").desc_nulls_last(), "attribute")
