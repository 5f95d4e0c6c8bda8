"""Equi-joins of a parent table with its child tables, divided by the pairs that a key makes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from rowlens.functions.columns import name
from rowlens.sources.files import stage

#: A key with fewer pairs than this is never divided; others are where they have more than a share of 1 / PARTS of a task's mean.
LEAST, PARTS = 10_000, 4
_SALT, _ROW, _COLUMN = "_salt", "_row", "_column"


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_counts(df: DataFrame, key: str, output: str) -> DataFrame:
    """Rows per key."""
    return df.groupBy(name(key)).agg(F.count(F.lit(1)).alias(output))


def _grids(counts: DataFrame, key: str, least: int) -> DataFrame | None:
    """(key, _rows, _columns): how many cells a key's pairs are divided into, for keys with more than a share of all pairs.

    ``counts`` is (key, _n, _m). One pass stages the keys with more than ``least`` pairs and adds up all pairs. A key is divided
    if it has more than 1 / (PARTS x tasks) of them, so there are at most PARTS x tasks such keys, whatever the tables hold. A
    cell has about that many pairs, of as many rows from either side where both have enough.
    """
    pairs, seen = F.col("_n").cast("double") * F.col("_m"), Observation()
    large = stage(counts.observe(seen, F.sum(pairs).alias("total")).where(pairs > least), "large")
    if large.isEmpty():
        return None
    share = max(float(least), seen.get["total"] / (PARTS * _tasks(counts)))
    cut = lambda mine, other: F.ceil(F.col(mine) / F.least(F.col(mine), F.greatest(F.lit(share**0.5), F.lit(share) / F.col(other)))).cast("int")
    return large.where(pairs > share).select(name(key), cut("_n", "_m").alias("_rows"), cut("_m", "_n").alias("_columns"))


def _own(df: DataFrame, cells: str) -> Column:
    """The number of a row's own cell: by a hash of the row and of the partition it was read in, which also divides copies of a row.

    A task that runs again repeats it, wherever it runs.
    """
    plain = [name(f.name) for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]
    return F.coalesce(F.pmod(F.xxhash64(F.spark_partition_id(), *plain), F.col(cells)), F.lit(0)).cast("int")


def _every(cells: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(cells), F.lit(1)) - 1))


def _join_cells(left: DataFrame, right: DataFrame, key: str, grids: DataFrame | None) -> DataFrame:
    """Inner join in which a key's rows of ``left`` are dealt to the rows of its grid and those of ``right`` to the columns.

    A row is copied to each cell of its row or column, so every pair meets in one cell.
    """
    if grids is None:
        return left.join(right, key)
    hint = F.broadcast(grids)  # at most PARTS x tasks rows
    rows = left.join(hint, key, "left")
    rows = rows.select(*(name(c) for c in left.columns), _own(left, "_rows").alias(_ROW), "_columns").select("*", _every("_columns").alias(_COLUMN)).drop("_columns")
    columns = right.join(hint, key, "left")
    columns = columns.select(*(name(c) for c in right.columns), _own(right, "_columns").alias(_COLUMN), "_rows").select("*", _every("_rows").alias(_ROW)).drop("_rows")
    return rows.join(columns, [key, _ROW, _COLUMN]).drop(_ROW, _COLUMN)


def join_pairs(
    left: DataFrame, right: DataFrame, key: str, left_counts: DataFrame | None = None, right_counts: DataFrame | None = None, least: int = LEAST
) -> DataFrame:
    """Inner join on ``key`` of two tables that both repeat it; the key column appears once. Runs a job that counts when called.

    A key that makes more pairs than a fair share is divided into a grid of cells, however few rows it has on either side:
    200 rows of each side make 40,000 pairs. ``left_counts`` and ``right_counts`` are (key, number of rows), where they are known by
    other means than counting, as after a join.
    """
    one = key_counts(left, key, "_n") if left_counts is None else left_counts.toDF(key, "_n")
    two = key_counts(right, key, "_m") if right_counts is None else right_counts.toDF(key, "_m")
    return _join_cells(left, right, key, _grids(one.join(two, key), key, least))


def join_children(parent: DataFrame, child: DataFrame, key: str, least: int = LEAST) -> DataFrame:
    """Inner join of a parent with unique keys to its child rows; the key column appears once. Runs a job that counts when called.

    The rows of a key with more than a share of the child are divided over tasks, and its parent row is copied to each.
    """
    counts = key_counts(child, key, "_m").withColumn("_n", F.lit(1).cast("bigint"))
    return _join_cells(parent, child, key, _grids(counts, key, least))


def join_all(parent: DataFrame, children: Sequence[DataFrame], key: str, least: int = LEAST) -> DataFrame:
    """One row per parent and combination of its child rows. How many a key has so far is the product of its counts: no join runs to count."""
    joined, before = parent, None
    for child in children:
        counts = key_counts(child, key, "_m")
        if before is None:
            joined, before = join_children(joined, child, key, least), counts.withColumnRenamed("_m", "_n")
            continue
        joined = join_pairs(joined, child, key, before, counts, least)
        before = before.join(counts, key).select(name(key), (F.col("_n") * F.col("_m")).alias("_n"))
    return joined


def _salt(df: DataFrame, key: str, spread: Sequence, copied: Sequence, splits: int, spread_null: bool = False) -> DataFrame:
    """Add the salt: rows of ``spread`` keys are divided, rows of ``copied`` keys are there once per salt.

    The salt of a divided row is the partition in which it was read, which a re-run
    task repeats exactly and which also divides copies of one row.
    """
    divided = name(key).isin(list(spread)) if spread else F.lit(False)
    if spread_null:
        divided = divided | name(key).isNull()
    salt = F.when(divided, F.pmod(F.spark_partition_id(), F.lit(splits))).otherwise(F.lit(0)).cast("int")
    salted = df.withColumn(_SALT, salt)
    if not copied:
        return salted
    every = F.sequence(F.lit(0), F.lit(splits - 1))
    return salted.withColumn(_SALT, F.explode(F.when(name(key).isin(list(copied)), every).otherwise(F.array(_SALT))))


def look_up(rows: DataFrame, table: DataFrame, key: str, hot: Sequence = (), splits: int | None = None) -> DataFrame:
    """Every row with the columns of the entry of ``table`` that has its key, or nulls.

    The table has one entry per key. Spark broadcasts it when its measured size
    allows; otherwise rows of hot keys and rows without a key are divided over tasks.
    """
    splits = splits or _tasks(rows)
    left = _salt(rows, key, hot, (), splits, spread_null=True)
    return left.join(_salt(table, key, (), hot, splits), [key, _SALT], "left").drop(_SALT)


def fanout_weights(
    parent: DataFrame, children: Mapping[str, DataFrame], key: str, weight: str = "weight"
) -> dict[str, DataFrame]:
    """The rows of each table with the number of joined rows they stand for.

    Joining a parent with two children on the parent's key yields one row for every
    pair of children of that parent. A statistic that reads the columns of one
    table needs no pairs: a row of one child counts once per row of the other
    children, and a parent row once per pair. The result holds each child (joined to
    its parent's columns) under its name and the parent under ``""``; weights are
    the products of per-key counts, so no pair is ever emitted. The parent's key must be unique. Runs a job when
    called: the parent with its counts is staged, as every result reads it.
    """
    counted = {child: f"_n_{child}" for child in children}
    base = reduce(lambda df, child: df.join(key_counts(children[child], key, counted[child]), key), children, parent)
    base = stage(base, "fanout")

    def with_weight(skipped: str | None) -> DataFrame:
        product = F.lit(1).cast("bigint")
        for child, n in counted.items():
            if child != skipped:
                product = product * F.col(n)
        return base.withColumn(weight, product).drop(*counted.values())

    weighted = {child: join_children(with_weight(child), df, key) for child, df in children.items()}
    weighted[""] = with_weight(None)
    return weighted
