"""Descriptive statistics. Every function is one lazy aggregate with partial aggregation."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowlens.functions.columns import name

def row_count(weight: str | None) -> Column:
    return F.sum(name(weight)).cast("bigint") if weight else F.count(F.lit(1))


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row (attribute, value as text) per listed column, from one scan."""
    stacked = [v for c in columns for v in (F.lit(c), name(c).cast("string"))]
    return df.select(*(name(c) for c in keep), F.stack(F.lit(len(columns)), *stacked).alias("attribute", "value"))


def category_counts(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Frequency tables of several columns as (attribute, value, n); null is a value.

    ``weight`` names a column with the number of rows that a row stands for.
    """
    long = long_values(df, columns, [weight] if weight else ())
    return long.groupBy("attribute", "value").agg(row_count(weight).alias("n"))


def decoded_counts(
    df: DataFrame,
    columns: Sequence[str],
    codebook: Mapping[str, Mapping[str, str]],
    weight: str | None = None,
) -> DataFrame:
    """Frequency tables after decoding.

    Codes are counted first and the short tables are decoded, so a label expression
    runs once per distinct code and not once per row. Codes that share a label add up.
    """
    counts = category_counts(df, columns, weight)
    known = {c: codebook[c] for c in columns if codebook.get(c)}
    if not known:
        return counts
    labels = _literal_map({c: _literal_map({k: F.lit(v) for k, v in codes.items()}) for c, codes in known.items()})
    label = F.try_element_at(F.try_element_at(labels, F.col("attribute")), F.col("value"))
    decoded = F.coalesce(label, F.col("value"))
    return counts.groupBy("attribute", decoded.alias("value")).agg(F.sum("n").alias("n"))


def _literal_map(entries: Mapping[str, Column]) -> Column:
    return F.create_map(*(part for key, value in entries.items() for part in (F.lit(key), value)))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per column, as numbers.

    Values are stacked and grouped by the position of their column: five aggregates
    stay compiled for any number of columns, where five per column would not.
    """
    stacked = [v for i, c in enumerate(columns) for v in (F.lit(i), name(c).cast("double"))]
    x = F.col("x")
    summary = (
        df.select(F.stack(F.lit(len(columns)), *stacked).alias("i", "x"))
        .groupBy("i")
        .agg(
            F.count(x).alias("n"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("stddev"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        )
    )
    names = F.array(*(F.lit(c) for c in columns))
    return summary.select(names[F.col("i")].alias("attribute"), "n", "mean", "stddev", "min", "max")


def covariance_pairs(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Sample covariance of each unordered pair of columns, over the rows that have both.

    Every pair has a row: its value is null with less than two such rows, and NaN if one of them holds NaN.
    ``weight`` names a column with the number of rows that a row stands for.
    """
    return covariances(pair_moments(df, columns, weight), columns)


def covariances(moments: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(attribute_a, attribute_b, covariance) of :func:`pair_moments`."""
    value = F.when(F.col("n") > 1, F.try_divide(F.col("cij"), F.col("n") - 1))
    a, b = _names(columns)
    return moments.filter("i < j").select(a.alias("attribute_a"), b.alias("attribute_b"), value.alias("covariance"))


def correlation_matrix(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Pearson correlation of every ordered pair, as (row_attr, col_attr, correlation).

    Each pair uses the rows that have both values and has a cell: null without such rows or without variation, NaN
    if one of them holds NaN. ``weight`` names a column with the number of rows that a row stands for.
    """
    return correlations(pair_moments(df, columns, weight), columns)


def correlations(moments: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(row_attr, col_attr, correlation) of :func:`pair_moments`."""
    cii, cjj = F.col("cii"), F.col("cjj")
    value = F.when((F.col("i") == F.col("j")) & ~F.isnan(cii), F.lit(1.0)).otherwise(F.try_divide(F.col("cij"), F.sqrt(cii) * F.sqrt(cjj)))
    upper = moments.select("i", "j", F.when((cii > 0) & (cjj > 0), value).alias("correlation"))
    both_ways = F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    cells = upper.select(F.explode(F.array_distinct(both_ways)).alias("cell"), "correlation").select("cell.*", "correlation")
    a, b = _names(columns)
    return cells.select(a.alias("row_attr"), b.alias("col_attr"), "correlation")


def correlation_wide(correlation: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The long matrix as one row per attribute with one column per attribute."""
    wide = correlation.groupBy("row_attr").pivot("col_attr", list(columns)).agg(F.first("correlation"))
    return wide.select("row_attr", *(name(c) for c in columns))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts per value of ``row`` and listed value of ``column``; absent cells are 0.

    The values are given, so no pass is spent on finding them and the columns are fixed.
    """
    text = name(column).cast("string")
    return df.groupBy(name(row).cast("string").alias(row)).agg(
        *(F.count_if(text == F.lit(v)).alias(f"{column}_{v}") for v in values)
    )


def crosstab_all(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts of all pairs of values as (row, column, n) in long form; null is a value, and absent pairs have no row."""
    pair = (name(row).cast("string").alias("row_value"), name(column).cast("string").alias("column_value"))
    return df.groupBy(*pair).agg(F.count(F.lit(1)).alias("n"))


def histogram_by_group(
    df: DataFrame, value: str, group: str, groups: Sequence[str] | None = None, bins: int = 20
) -> DataFrame:
    """Equal-width histogram of ``value`` for each value of ``group`` on common bins.

    Yields (group, bin, lower, upper, n) with every bin of every group, also empty
    ones. The last bin holds the maximum; if all values are equal there is one bin.
    ``groups`` restricts the rows, and the range of the bins, to the listed groups.
    """
    label = name(group).cast("string")
    rows = df.select(label.alias("group"), name(value).cast("double").alias("x"))
    rows = rows.filter(F.col("x").isNotNull() & F.col("group").isNotNull())
    if groups is not None:
        rows = rows.filter(F.col("group").isin(*groups))
    bounds = rows.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high")).alias("b")).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    width = (high - low) / F.lit(float(bins))
    place = F.when(high == low, 0).otherwise(F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)))
    counts = rows.groupBy("group", place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # At most `bins` entries per group.
    per_group = counts.groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("filled"))
    last = F.when(high == low, 0).otherwise(bins - 1)
    dense = per_group.select("group", "filled", F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    return dense.select(
        "group",
        "bin",
        (low + F.col("bin") * width).alias("lower"),
        F.when(F.col("bin") == last, high).otherwise(low + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0)).cast("bigint").alias("n"),
    )


def top_k(df: DataFrame, score: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest score; each task keeps k rows only."""
    return df.orderBy(name(score).desc_nulls_last(), *(name(c) for c in ties)).limit(k)


def _names(columns: Sequence[str]) -> tuple[Column, Column]:
    names = F.array(*(F.lit(c) for c in columns))
    return names[F.col("i")], names[F.col("j")]


_MOMENTS = "i int, j int, n double, mi double, mj double, cii double, cjj double, cij double"


def pair_moments(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Centred second moments (i, j, n, cii, cjj, cij) of all pairs i <= j from one scan.

    Matrix products inside the tasks give one row of moments per pair and task; only
    those are shuffled. They are merged around the common mean, so no digits are lost
    to large values. An aggregate with one expression per pair is slower from about
    ten columns on, as its generated code gets too long to be compiled, and so is one over rows of (pair, x, y).
    """
    values = df.select(*(name(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)))
    pairs = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(len(columns)) for j in range(i, len(columns))))
    # A pair that no task has rows of still has its place.
    zero = [F.lit(0.0).alias(c) for c in ("n", "mi", "mj", "cii", "cjj", "cij")]
    every = df.sparkSession.range(1).select(F.explode(pairs).alias("pair")).select("pair.i", "pair.j", *zero)
    if weight:
        values = df.select(*(name(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)), name(weight).cast("double").alias("w"))
    parts = values.mapInArrow(_task_moments(weight is not None), _MOMENTS).unionByName(every)
    pair = Window.partitionBy("i", "j")
    n = F.col("n")
    gap_i = F.col("mi") - F.try_divide(F.sum(n * F.col("mi")).over(pair), F.sum(n).over(pair))
    gap_j = F.col("mj") - F.try_divide(F.sum(n * F.col("mj")).over(pair), F.sum(n).over(pair))
    gaps = parts.select("i", "j", n, "cii", "cjj", "cij", gap_i.alias("gi"), gap_j.alias("gj"))
    return gaps.groupBy("i", "j").agg(
        F.sum("n").alias("n"),
        F.sum(F.expr("cii + n * gi * gi")).alias("cii"),
        F.sum(F.expr("cjj + n * gj * gj")).alias("cjj"),
        F.sum(F.expr("cij + n * gi * gj")).alias("cij"),
    )


def _task_moments(weighted: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Count, means and centred moments per pair, over the rows of a task that have both values.

    The inner function travels to the tasks by value, so executors need no copy of this package.
    """

    def moments_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, shift, spoilt = None, None, False
        for batch in batches:
            columns = batch.columns[:-1] if weighted else batch.columns
            w = batch.columns[-1].to_numpy(zero_copy_only=False)[:, None] if weighted else np.ones((batch.num_rows, 1))
            x = np.column_stack([np.asarray(c.to_numpy(zero_copy_only=False), dtype=float) for c in columns])
            given = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
            has = ~np.isnan(x)
            odd = (given & ~has).astype(float)  # NaN is a value, unlike null
            if odd.any():
                met = odd.T @ given.astype(float)
                spoilt = (met + met.T > 0) | spoilt
            if shift is None:
                # Any value near the data keeps the sums below small.
                shift = np.where(has, x, 0.0).sum(axis=0) / np.maximum(has.sum(axis=0), 1)
            x -= shift
            if has.all():
                ones = np.ones(x.shape[1])
                first, square = np.outer((x * w).sum(axis=0), ones), np.outer((x * x * w).sum(axis=0), ones)
                counts = np.full((x.shape[1], x.shape[1]), float(w.sum()))
            else:
                x[~has] = 0.0
                mask = has.astype(float)
                first, square, counts = x.T @ (mask * w), (x * x).T @ (mask * w), mask.T @ (mask * w)
            part = np.stack([counts, first, first.T, square, square.T, (x * w).T @ x])
            sums = part if sums is None else sums + part
        if sums is None:
            return
        i, j = np.triu_indices(sums.shape[1])
        spoilt = np.broadcast_to(spoilt, sums.shape[1:])[i, j]
        n, si, sj, sii, sjj, sij = sums[:, i, j]
        m = np.maximum(n, 1)
        centred = [np.where(spoilt, np.nan, c) for c in (sii - si * si / m, sjj - sj * sj / m, sij - si * sj / m)]
        # A NaN counts as a row that both have, so that two of them are enough for a value.
        moments = (np.where(spoilt, np.maximum(n, 2), n), shift[i] + si / m, shift[j] + sj / m, *centred)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(m, pa.float64()) for m in moments)]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "n", "mi", "mj", "cii", "cjj", "cij"])

    return moments_of
