"""Stratified samples and train/test splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlens.functions.columns import name, unit_hash


def _keys(key: Sequence[str]) -> list[Column]:
    return [name(c) for c in key]


def stratified_sample(df: DataFrame, column: str, fractions: Mapping[object, float], seed: int) -> DataFrame:
    """Spark's own Bernoulli sample per stratum; which rows it keeps depends on the partitioning."""
    return df.sampleBy(name(column), dict(fractions), seed)


def stratified_sample_hash(
    df: DataFrame, column: str, fractions: Mapping[object, float], key: Sequence[str], seed: int
) -> DataFrame:
    """Sample per stratum by a hash of the row key: the same rows on any plan, and no shuffle.

    Strata that are not listed, and null, are dropped.
    """
    fraction = F.lit(None).cast("double")
    for value, share in fractions.items():
        fraction = F.when(name(column).cast("string") == F.lit(str(value)), F.lit(float(share))).otherwise(fraction)
    return df.filter(unit_hash(seed, _keys(key)) < fraction)


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's own random split."""
    return df.randomSplit(list(weights), seed)


def split_hash(df: DataFrame, train_share: float, key: Sequence[str], seed: int) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: disjoint, complete, the same on any plan."""
    is_train = unit_hash(seed, _keys(key)) < F.lit(float(train_share))
    return df.filter(is_train), df.filter(~is_train)
