"""Category indexes, feature vectors and feature selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlens.functions.columns import name
from rowlens.operators.infogain import label_counts_by_value
from rowlens.operators.ordered import in_blocks, running_totals
from rowlens.operators.profile import category_counts
from rowlens.operators.relate import look_up
from rowlens.session import new_folder


def string_index_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(attribute, value, n, total, index): rank of each value by descending count, ties by value.

    All columns share one scan. The ranking is distributed, so a column may have any
    number of values; null gets no index.
    """
    order = [F.col("n").desc(), F.col("value").asc()]
    counts = category_counts(df, columns).filter(F.col("value").isNotNull()).withColumn("one", F.lit(1).cast("bigint"))
    ranked = running_totals(in_blocks(counts, ["attribute"], order), ["attribute"], order, ["one", "n"])
    index = (F.col("cum_one") - 1).cast("double")
    return ranked.select("attribute", "value", "n", F.col("all_n").alias("total"), index.alias("index"))


def apply_index(df: DataFrame, table: DataFrame, columns: Sequence[str], hot_share: float = 0.01) -> DataFrame:
    """Replace each column by its index from :func:`string_index_table`. Runs its jobs when called.

    The table is staged once, a folder for each column, so that the ranking does not run again and a short list is
    joined by its own size beside a long one. Its counts tell which values more than ``hot_share`` of the rows
    have; the rows of these few are divided over tasks in a join that cannot be broadcast.
    """
    return _encode(df, table, list(columns), hot_share)[0]


def _encode(
    df: DataFrame, table: DataFrame, columns: list[str], hot_share: float = 0.01, rest: str | None = None
) -> tuple[DataFrame, dict[str, int], dict[str, float]]:
    """The rows with indexes, and for each column that has any values their number and the least of ``rest``."""
    place = F.array_position(F.array(*(F.lit(c) for c in columns)), F.col("attribute")) - 1
    placed = table.withColumn("_column", place.cast("int")).filter("_column >= 0")
    path = new_folder(df.sparkSession, "index")
    placed.write.partitionBy("_column").parquet(path)
    kept = df.sparkSession.read.schema(placed.schema).parquet(path)
    found = kept.groupBy("_column").agg(F.count("*").alias("n"), F.min(rest or F.lit(None).cast("double")).alias("rest")).collect()
    sizes = {columns[row["_column"]]: row.n for row in found}
    rests = {columns[row["_column"]]: row.rest for row in found}
    # No more than 1 / hot_share values per column can have such a share.
    hot = kept.filter(F.col("n") > F.col("total") * hot_share).select("attribute", "value").collect()
    encoded = df
    for at, c in enumerate(columns):
        if c not in sizes:
            encoded = encoded.withColumn(c, F.lit(None).cast("double"))
            continue
        entries = df.sparkSession.read.schema("value string, index double").parquet(f"{path}/_column={at}")
        mapping = entries.select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        keyed = encoded.withColumn("_value", name(c).cast("string"))
        joined = look_up(keyed, mapping, "_value", [row.value for row in hot if row.attribute == c])
        encoded = joined.select(*(F.col("_index").alias(c) if x == c else name(x) for x in df.columns))
    return encoded, sizes, rests


def index_for_models(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nominal columns by category indexes that tree models know as such. Runs its jobs when called.

    The column says how many values it has and not which, so it may have any number; a model of trees must be set to as
    many bins. Null gets no index, and :func:`assemble` refuses it.
    """
    columns = list(columns)
    if not columns:
        return df
    encoded, sizes, _ = _encode(df, string_index_table(df, columns), columns)
    kinds = {c: {"ml_attr": {"type": "nominal", "name": c, "num_vals": n}} for c, n in sizes.items()}
    return encoded.select(*(name(c).alias(c, metadata=kinds[c]) if c in kinds else name(c) for c in encoded.columns))


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Numeric and indexed columns as one vector; a null is an error."""
    safe = [f"_f_{i}" for i in range(len(columns))]
    named = df.select("*", *(name(c).alias(s) for c, s in zip(columns, safe, strict=True)))
    return VectorAssembler(inputCols=safe, outputCol=output, handleInvalid="error").transform(named).drop(*safe)


def select_by_gain_ratio(df: DataFrame, ranking: DataFrame, threshold: float, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the ranked columns whose gain ratio is below ``threshold`` or undefined.

    ``ranking`` is a gain ratio table: one row per column, read as names.
    """
    weak = ranking.filter(F.col("gain_ratio").isNull() | (F.col("gain_ratio") < F.lit(threshold))).collect()
    return df.drop(*(row.attribute for row in weak if row.attribute not in keep))


def label_order_table(train: DataFrame, columns: Sequence[str], label: str, positive: object) -> DataFrame:
    """(attribute, value, n, t, total, index, rest): rank of each value by its share of the positive class, ties by value.

    Read as an ordered column, the ranks keep the best binary split of a category exact for two classes, so that a tree needs no set of
    values and a column may have more of them than the tree has bins. ``rest`` is the rank at which the share of all rows stands, for values that
    ``train`` does not have. Ranking is distributed; null gets no rank. Give rows that a model is trained on, and no others.
    """
    counts = label_counts_by_value(train, label, positive, columns).filter(F.col("value").isNotNull())
    counts = counts.select("attribute", "value", "n", F.col("n_true").alias("t"), (F.col("n_true") / F.col("n")).alias("share"), F.lit(1).cast("bigint").alias("one"))
    order = [F.col("share").asc(), F.col("value").asc()]
    ranked = running_totals(in_blocks(counts, ["attribute"], order), ["attribute"], order, ["one", "n", "t"])
    ranked = ranked.withColumn("index", (F.col("cum_one") - 1).cast("double"))
    below = F.sum(F.when(F.col("share") * F.col("all_n") < F.col("all_t"), F.col("one")))
    rests = ranked.groupBy("attribute").agg((F.coalesce(below, F.lit(0)) - 0.5).cast("double").alias("rest"))
    return ranked.join(rests, "attribute").select("attribute", "value", "n", "t", F.col("all_n").alias("total"), "index", "rest")


def code_by_label(df: DataFrame, train: DataFrame, columns: Sequence[str], label: str, positive: object) -> DataFrame:
    """Replace nominal columns by the ranks of :func:`label_order_table`, as ordered numbers. Runs its jobs when called.

    A value that ``train`` does not have gets the rank of the share of all rows, null stays null.
    """
    columns = list(columns)
    if not columns:
        return df
    table = label_order_table(train, columns, label, positive)
    given = df.select("*", *(name(c).isNotNull().alias(f"_has_{i}") for i, c in enumerate(columns)))
    encoded, _, rests = _encode(given, table, columns, rest="rest")
    filled = [F.coalesce(name(c), F.when(name(f"_has_{columns.index(c)}"), F.lit(rests.get(c)))).alias(c) if c in columns else name(c) for c in df.columns]
    return encoded.select(*filled)


def code_categories(df: DataFrame, train: DataFrame, columns: Sequence[str], label: str, positive: object, bins: int) -> DataFrame:
    """Nominal columns for models of trees with ``bins`` bins: category indexes, or ranks by label where a column has more values than bins."""
    distinct = df.agg(*(F.approx_count_distinct(name(c)).alias(f"n{i}") for i, c in enumerate(columns))).first() if columns else []
    # The estimate is some percent off, so a column that may have more values counts as one that has.
    many = [c for c, n in zip(columns, distinct, strict=True) if n * 1.2 > bins]
    return code_by_label(index_for_models(df, [c for c in columns if c not in many]), train, many, label, positive)


def choose_features(ranking: DataFrame, correlation: DataFrame, least_gain: float, most_correlation: float) -> DataFrame:
    """(place, attribute, gain_ratio, kept, reason, like): which attributes to keep, best ranked first.

    An attribute goes if its gain ratio is below ``least_gain`` or undefined, or if it correlates by more than ``most_correlation``, either way, with
    one that is kept: ``like`` names the best ranked of these. ``ranking`` is a gain ratio table, ``correlation`` a correlation matrix in long
    form; pairs that it lacks do not correlate. Both have a row for each column or pair of columns, so one row holds them.
    """
    ranked = ranking.agg(F.sort_array(F.collect_list(F.struct((-F.coalesce("gain_ratio", F.lit(-1.0))).alias("order"), "attribute", "gain_ratio"))).alias("ranked"))
    known = correlation.where(F.col("correlation").isNotNull() & ~F.isnan("correlation"))
    strong = known.where((F.abs("correlation") > most_correlation) & (F.col("row_attr") != F.col("col_attr")))
    strong = strong.groupBy("row_attr").agg(F.collect_set("col_attr").alias("others"))
    strong = strong.agg(F.map_from_entries(F.collect_list(F.struct("row_attr", "others"))).alias("strong"))
    kind = "array<struct<attribute: string, gain_ratio: double, kept: boolean, reason: string, like: string>>"

    def add(chosen: Column, one: Column) -> Column:
        others = F.coalesce(F.try_element_at("strong", one["attribute"]), F.array().cast("array<string>"))
        like = F.get(F.filter(chosen, lambda c: c["kept"] & F.array_contains(others, c["attribute"])), F.lit(0))["attribute"]
        weak = one["gain_ratio"].isNull() | (one["gain_ratio"] < least_gain)
        reason = F.when(weak, "gain").when(like.isNotNull(), "correlation")
        row = F.struct(
            one["attribute"].alias("attribute"), one["gain_ratio"].cast("double").alias("gain_ratio"), reason.isNull().alias("kept"), reason.alias("reason"),
            F.when(~weak, like).alias("like"),
        )
        return F.concat(chosen, F.array(row)).cast(kind)

    chosen = F.aggregate("ranked", F.array().cast(kind), add)
    both = ranked.withColumn("strong", strong.scalar())
    return both.select(F.posexplode(chosen).alias("place", "row")).select((F.col("place") + 1).alias("place"), "row.*")


def select_features(df: DataFrame, choice: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the columns that :func:`choose_features` does not keep; the driver reads their names."""
    return df.drop(*(row.attribute for row in choice.filter(~F.col("kept")).select("attribute").collect() if row.attribute not in keep))
