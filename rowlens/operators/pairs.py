"""Statistics over all joined pairs of a parent's children, without forming a pair.

A value of one table counts as often as its key has rows in the other tables. For columns of two children, sums over the pairs of a key are
products of the key's own sums. Nothing grows with the pairs: each table is joined once to one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlens.functions.columns import name
from rowlens.operators.profile import correlations, covariances, pair_moments
from rowlens.operators.relate import fanout_weights, key_counts

_WEIGHT = "_pairs"


def _homes(parent: DataFrame, children: Mapping[str, DataFrame], key: str, columns: Sequence[str]) -> dict[str, list[str]]:
    """The listed columns of each table; "" is the parent. The key is the parent's."""
    homes: dict[str, list[str]] = {"": [], **{child: [] for child in children}}
    for c in columns:
        has = [table for table, df in {"": parent, **children}.items() if c in df.columns and (table == "" or c != key)]
        if len(has) != 1:
            raise ValueError(f"column {c} is in {len(has)} of the tables")
        homes[has[0]].append(c)
    return homes


def _weighted(parent: DataFrame, children: Mapping[str, DataFrame], key: str, homes: Mapping[str, list[str]]) -> dict[str, DataFrame]:
    narrow = lambda df, table: df.select(*(name(c) for c in dict.fromkeys([key, *homes[table]])))
    return fanout_weights(narrow(parent, ""), {child: narrow(df, child) for child, df in children.items()}, key, _WEIGHT)


def _middles(df: DataFrame, columns: Sequence[str]) -> Column:
    """A struct with a value about the middle of each column: sums of squares around it keep their digits.

    A mean and a median differ by a standard deviation at most, and a few outliers do not move the median.
    """
    middle = lambda x: F.percentile_approx(F.when(x - x == 0, x), 0.5, 100)
    middles = [F.coalesce(middle(name(c).cast("double")), F.lit(0.0)).alias(f"m{i}") for i, c in enumerate(columns)]
    return df.agg(F.struct(*middles).alias("middles")).scalar()


def describe_of_pairs(parent: DataFrame, children: Mapping[str, DataFrame], key: str, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum of columns of any of the tables, over the joined pairs.

    The same as the summary of the joined table: a row of a child counts once for each combination of rows that its key has in the other
    children, and not at all where one of them or the parent lacks the key. The parent's keys must be unique. Runs a job when called.
    """
    homes = _homes(parent, children, key, columns)
    places = {c: i for i, c in enumerate(columns)}
    weighted, parts = _weighted(parent, children, key, homes), []
    for table, listed in homes.items():
        if not listed:
            continue
        near = _middles(children.get(table, parent), listed)
        stacked = [v for i, c in enumerate(listed) for v in (F.lit(places[c]), name(c).cast("double"), near.getField(f"m{i}"))]
        rows = weighted[table].select(_WEIGHT, F.stack(F.lit(len(listed)), *stacked).alias("i", "x", "near"))
        gap, w = F.col("x") - F.col("near"), F.when(F.col("x").isNotNull(), F.col(_WEIGHT))
        sums = rows.groupBy("i").agg(
            F.coalesce(F.sum(w), F.lit(0)).cast("bigint").alias("n"), F.first("near").alias("near"), F.sum(w * gap).alias("first"),
            F.sum(w * gap * gap).alias("second"), F.min("x").alias("min"), F.max("x").alias("max"),
        )
        parts.append(sums)
    sums = reduce(DataFrame.unionByName, parts)
    shift, names = F.try_divide(F.col("first"), F.col("n")), F.array(*(F.lit(c) for c in columns))
    left = F.col("second") - F.col("n") * shift * shift
    spread = F.sqrt(F.try_divide(F.when(left < 0, 0.0).otherwise(left), F.col("n") - 1))
    return sums.select(names[F.col("i")].alias("attribute"), "n", (F.col("near") + shift).alias("mean"), F.when(F.col("n") > 1, spread).alias("stddev"), "min", "max")


def moments_of_pairs(parent: DataFrame, children: Mapping[str, DataFrame], key: str, columns: Sequence[str]) -> DataFrame:
    """Centred second moments (i, j, n, cii, cjj, cij) of all pairs i <= j of columns, over the joined pairs that have both values.

    Two columns of one child, or of a child and the parent, are read from that child's rows with weights. Two columns of different children
    are read from counts, sums and sums of squares per key. The parent's keys must be unique. Runs a job when called.
    """
    homes = _homes(parent, children, key, columns)
    weighted = _weighted(parent, children, key, homes)
    parts = []
    for table in homes:
        listed = [c for c in columns if c in homes[table] or c in homes[""]]
        own = F.array(*(F.lit(c in homes[table]) for c in listed))
        place = F.array(*(F.lit(columns.index(c)) for c in listed))
        if not homes[table]:
            continue
        found = pair_moments(weighted[table], listed, _WEIGHT)
        found = found.where(own[F.col("i")] | own[F.col("j")]) if table else found
        parts.append(found.withColumns({"i": place[F.col("i")], "j": place[F.col("j")]}))
    for one, two in combinations([child for child in children if homes[child]], 2):
        parts.append(_moments_of_two(parent, children, key, columns, homes, one, two))
    return reduce(DataFrame.unionByName, parts)


def _key_sums(df: DataFrame, key: str, columns: Sequence[str], prefix: str) -> DataFrame:
    """Per key and column: the number of values, and their sum and sum of squares around a value in their middle, as three arrays."""
    near = _middles(df, columns)
    gap = [name(c).cast("double") - near.getField(f"m{i}") for i, c in enumerate(columns)]
    sums = {"n": [F.count(g).cast("double") for g in gap], "s": [F.coalesce(F.sum(g), F.lit(0.0)) for g in gap], "q": [F.coalesce(F.sum(g * g), F.lit(0.0)) for g in gap]}
    flat = [v.alias(f"{prefix}{k}{i}") for k, values in sums.items() for i, v in enumerate(values)]
    arrays = [F.array(*(f"{prefix}{k}{i}" for i in range(len(columns)))).alias(f"{prefix}{k}") for k in sums]
    return df.groupBy(name(key)).agg(*flat).select(name(key), *arrays)


def _moments_of_two(parent: DataFrame, children: Mapping[str, DataFrame], key: str, columns: Sequence[str], homes: Mapping[str, list[str]], one: str, two: str) -> DataFrame:
    """Moments of each column of one child with each of another."""
    keys = parent.select(name(key)).join(_key_sums(children[one], key, homes[one], "a"), key).join(_key_sums(children[two], key, homes[two], "b"), key)
    times = F.lit(1.0)
    for other in children:
        if other not in (one, two):
            keys = keys.join(key_counts(children[other], key, f"_n_{other}"), key)
            times = times * name(f"_n_{other}")
    width = len(homes[two])
    rows = keys.select(times.alias("times"), "an", "as", "aq", "bn", "bs", "bq", F.explode(F.sequence(F.lit(0), F.lit(len(homes[one]) * width - 1))).alias("cell"))
    a = lambda k: F.get(f"a{k}", F.floor(F.col("cell") / width).cast("int"))
    b = lambda k: F.get(f"b{k}", F.col("cell") % width)
    total = lambda x, y: F.sum(F.col("times") * a(x) * b(y))
    terms = {"n": ("n", "n"), "sx": ("s", "n"), "sy": ("n", "s"), "sxx": ("q", "n"), "syy": ("n", "q"), "sxy": ("s", "s")}
    sums = rows.groupBy("cell").agg(*(total(x, y).alias(c) for c, (x, y) in terms.items()))
    # Pairs of columns in their order in the list; a cell without keys still has its place.
    cells = F.array(*(F.struct(F.lit(columns.index(x)).alias("x"), F.lit(columns.index(y)).alias("y")) for x in homes[one] for y in homes[two]))
    empty = parent.sparkSession.range(1).select(F.posexplode(cells).alias("cell", "_")).select("cell", *(F.lit(0.0).alias(c) for c in terms))
    sums = sums.unionByName(empty).groupBy("cell").agg(*(F.sum(c).alias(c) for c in terms))
    centred = lambda xy, x, y: F.col(xy) - F.coalesce(F.try_divide(F.col(x) * F.col(y), F.col("n")), F.lit(0.0))
    at = cells[F.col("cell")]
    turned = at["x"] > at["y"]
    xx, yy = F.greatest(centred("sxx", "sx", "sx"), F.lit(0.0)), F.greatest(centred("syy", "sy", "sy"), F.lit(0.0))
    return sums.select(
        F.least(at["x"], at["y"]).alias("i"), F.greatest(at["x"], at["y"]).alias("j"), "n",
        F.when(turned, yy).otherwise(xx).alias("cii"), F.when(turned, xx).otherwise(yy).alias("cjj"), centred("sxy", "sx", "sy").alias("cij"),
    )


def covariance_of_pairs(parent: DataFrame, children: Mapping[str, DataFrame], key: str, columns: Sequence[str]) -> DataFrame:
    """Sample covariance of each unordered pair of columns of any of the tables, over the joined pairs that have both."""
    return covariances(moments_of_pairs(parent, children, key, columns), columns)


def correlation_of_pairs(parent: DataFrame, children: Mapping[str, DataFrame], key: str, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns of any of the tables, over the joined pairs that have both."""
    return correlations(moments_of_pairs(parent, children, key, columns), columns)
