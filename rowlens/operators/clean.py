"""Projection, missing values, imputation and recoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowlens.functions.columns import band, blank, both, name, parse_epoch, ratio, recode
from rowlens.operators.relate import look_up


def project(
    df: DataFrame,
    keep: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Keep, drop and rename columns in one projection; unknown names in ``drop`` are ignored."""
    rename = rename or {}
    gone = set(drop)
    names = [c for c in (keep if keep is not None else df.columns) if c not in gone]
    return df.select(*(name(c).alias(rename.get(c, c)) for c in names))


def add_epoch(
    df: DataFrame,
    date: str,
    time: str,
    output: str,
    date_pattern: str = "dd/MM/yyyy",
    time_pattern: str = "HH:mm",
) -> DataFrame:
    """Join a date text and a time text to epoch seconds in ``output``; the texts are dropped."""
    epoch = parse_epoch(name(date), name(time), date_pattern, time_pattern)
    kept = [name(c) for c in df.columns if c not in (date, time, output)]
    return df.select(*kept, epoch.alias(output))


def sentinel_to_null(df: DataFrame, columns: Sequence[str], sentinel: str = "-1") -> DataFrame:
    """Turn the code for "missing" into null in the listed columns, each in its own type."""
    listed = set(columns)
    return df.select(
        *(
            blank(name(f.name), f.dataType, sentinel).alias(f.name) if f.name in listed else name(f.name)
            for f in df.schema
        )
    )


def filter_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every listed column has a value.

    It is a plain conjunction and not ``dropna``: Catalyst splits a conjunction over
    the sides of a join and pushes each part to its scan.
    """
    return df.filter(both([name(c).isNotNull() for c in columns]))


def null_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls per column, long form, in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count(name(c)).alias(f"c{i}") for i, c in enumerate(columns)),
    )
    stacked = [v for i, c in enumerate(columns) for v in (F.lit(c), F.col("n_rows") - F.col(f"c{i}"))]
    long = counts.select("n_rows", F.stack(F.lit(len(columns)), *stacked).alias("attribute", "n_null"))
    return long.select("attribute", "n_rows", "n_null", ratio(F.col("n_null"), F.col("n_rows")).alias("null_fraction"))


def drop_sparse(df: DataFrame, threshold: float, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop the columns whose share of nulls is above ``threshold`` (one small action)."""
    sparse = null_fractions(df, columns).filter(F.col("null_fraction") > threshold).collect()
    return df.drop(*(row.attribute for row in sparse))


def fill_when(df: DataFrame, column: str, condition: Column, value: object) -> DataFrame:
    """Fill nulls of ``column`` with ``value`` only where ``condition`` holds."""
    filled = F.when(name(column).isNull() & condition, F.lit(value)).otherwise(name(column))
    return df.withColumn(column, filled.cast(df.schema[column].dataType))


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill nulls with one constant per column, cast to the column's type."""
    return df.withColumns(
        {c: F.coalesce(name(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()}
    )


def mean_sources(columns: Sequence[str], bands: Mapping[str, tuple[str, Sequence[float]]]) -> list[str]:
    """The columns whose means :func:`fill_means` needs."""
    return list(dict.fromkeys([*columns, *(source for source, _ in bands.values())]))


def column_means(df: DataFrame, columns: Sequence[str]) -> Column:
    """Means of the non-null values as one scalar subquery: a struct with a field per column."""
    means = df.agg(F.struct(*(F.avg(name(c)).alias(c) for c in columns)).alias("means"))
    return means.scalar()


def fill_means(
    df: DataFrame,
    columns: Sequence[str],
    bands: Mapping[str, tuple[str, Sequence[float]]] | None = None,
    means: Column | None = None,
) -> DataFrame:
    """Fill nulls with the column's mean; an integer column gets the truncated mean.

    ``bands`` maps a banded column to (source column, upper bounds): its nulls get
    the band of the source column's mean. ``means`` is a struct of the means where they are known, as those of more rows than ``df`` has.
    """
    bands = bands or {}
    if means is None:
        means = column_means(df, mean_sources(columns, bands))
    fills = {c: means.getField(c) for c in columns}
    fills.update({c: band(means.getField(source), bounds) for c, (source, bounds) in bands.items()})
    return df.withColumns({c: F.coalesce(name(c), v.cast(df.schema[c].dataType)) for c, v in fills.items()})


def add_band(df: DataFrame, column: str, upper_bounds: Sequence[float], output: str) -> DataFrame:
    return df.withColumn(output, band(name(column), upper_bounds))


def to_nominal(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast columns to string, so that they count as categories."""
    return df.withColumns({c: name(c).cast(T.StringType()) for c in columns})


def binarize(df: DataFrame, column: str, zero_value: str, output: str) -> DataFrame:
    """0 where ``column`` has the given value, else 1 (also where it is null)."""
    return df.withColumn(output, F.when(name(column).cast("string") == F.lit(zero_value), 0).otherwise(1))


def decode_values(df: DataFrame, codebook: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Replace codes by labels in several string columns, in one projection.

    Columns of the codebook that the table lacks are skipped; a code without a label stays.
    """
    present = {c: labels for c, labels in codebook.items() if c in df.columns}
    return df.withColumns({c: recode(name(c).cast("string"), labels) for c, labels in present.items()})


def decode_join(
    df: DataFrame, column: str, dictionary: DataFrame, code: str, label: str, output: str, hot: Sequence[str] = ()
) -> DataFrame:
    """Replace codes by the labels of a dictionary table, for dictionaries too long for an expression.

    ``hot`` lists codes (as text) that very many rows share, for a dictionary that is
    also too long to broadcast.
    """
    # A repeated code must not multiply rows.
    entries = dictionary.groupBy(name(code).cast("string").alias("_code")).agg(F.min(name(label)).alias("_label"))
    labelled = look_up(df.withColumn("_code", name(column).cast("string")), entries, "_code", hot)
    kept = [name(c) for c in df.columns if c != output]
    return labelled.select(*kept, F.coalesce("_label", "_code").alias(output))
