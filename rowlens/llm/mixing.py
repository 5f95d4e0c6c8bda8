"""Mixing of sources to target weights by hash-random order and exact budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowlens.llm.common import WORD, stage
from rowlens.operators.ordered import in_blocks, running_totals

_NO_ID = -(1 << 63)
#: The place of a row in its source; ``_row`` numbers the rows of a staged table, so that rows equal in all else have places of their own.
_ORDER = ["_order", "_id", "_text", "_row"]


def word_count(text: str | Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def given_key(key: str) -> Column:
    """The key as it was given: a null is a number inside."""
    return F.when(F.col(key) != _NO_ID, F.col(key))


def _keyed(docs: DataFrame, key: str, text: str, source: str) -> dict[str, Column]:
    ids = F.coalesce(docs[f"`{key}`"].cast("long"), F.lit(_NO_ID))
    return {
        "_id": ids,
        "_source": F.coalesce(F.concat(F.lit("s"), docs[f"`{source}`"]), F.lit("n")),  # a null source is a source of its own
        "_order": F.xxhash64(F.lit(8), ids),
        "_text": F.xxhash64(F.lit(8), docs[f"`{text}`"]),  # rows that share a key are apart by their texts
    }


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Add ``target`` to (_source, source_size): budgets in proportion to weights, none above ``most`` times its source.

    Sources in code point order (a null source last) weigh as ``weights`` says, repeating. In order of the cap for each
    unit of weight, a source is capped if the rest of the budget, shared by the rest of the weights, exceeds its cap;
    that is where resharing the excess again and again ends. One row per source is sorted in one task.
    """
    every = Window.orderBy(F.col("_source") == "n", "_source")
    listed = F.array(*(F.lit(float(w)) for w in weights))
    weighed = sources.withColumn("_weight", F.element_at(listed, (F.row_number().over(every) - 1) % len(weights) + 1)).withColumn(
        "_cap", F.col("source_size") * F.lit(float(most))
    )
    rising = Window.orderBy(F.col("_cap") / F.col("_weight"), "_source")
    budget = F.sum("source_size").over(Window.partitionBy(F.lit(0))) * F.lit(float(share))
    capped = F.coalesce(F.sum("_cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rated = weighed.withColumn("_rate", (budget - capped) / rest)
    free = F.col("_cap") > F.col("_rate") * F.col("_weight")
    rate = F.min(F.when(free, F.struct(F.col("_cap") / F.col("_weight"), "_source", "_rate"))).over(Window.partitionBy(F.lit(0)))
    return rated.withColumn("_all", rate["_rate"]).select(
        "_source",
        "source_size",
        F.coalesce(F.least("_cap", F.col("_all") * F.col("_weight")), F.col("_cap")).alias("target"),
    )


def mixture(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
) -> tuple[DataFrame, DataFrame]:
    """Sizes of all rows, and one row per source that says what the mix takes from it.

    Every row has a hash-random place in its source. Rows are range-partitioned by (source, place), so a source with a
    third of all rows is many ranges; sums within ranges and over the ranges before give each row's distributed prefix
    sum. A source's budget buys ``whole`` epochs, and of one more the rows before the cut and the first ``part`` words of
    the row at the cut. Runs its jobs when called; only keys, hashes and sizes are staged.

    A null text has no words. A null source is a source; a null key is a key. Rows that share a key have places by their texts;
    of rows with the same text, too, as many are before the cut as the budget buys, whichever they are. ``cut_keep`` says how
    many of those at the cut's key and text a mix of whole rows takes: the last one, if at least half of it is bought.
    """
    rows = stage(
        docs.select(
            *(c.alias(n) for n, c in _keyed(docs, key, text, source).items()), word_count(docs[f"`{text}`"]).alias("size"), F.monotonically_increasing_id().alias("_row")
        ),
        "sizes",
    )
    sources = targets(rows.groupBy("_source").agg(F.sum("size").alias("source_size")), weights, share, most)
    order = [F.col(c) for c in _ORDER]
    sums = running_totals(in_blocks(rows, ["_source"], order), ["_source"], order, ["size"])
    budget = F.round("target").cast("long")
    bought = sources.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)).withColumn(
        "_rest", budget - F.col("whole") * F.col("source_size")
    )
    crossing = (
        sums.join(bought.select("_source", "_rest"), "_source")
        .where((F.col("cum_size") - F.col("size") <= F.col("_rest")) & (F.col("_rest") < F.col("cum_size")))
        .groupBy("_source")
        .agg(F.min(F.struct(*_ORDER, (F.col("_rest") - F.col("cum_size") + F.col("size")).alias("part"), "size")).alias("cut"))
    )
    plan = bought.join(crossing, "_source", "left").select(
        "_source",
        "source_size",
        "target",
        "whole",
        *(F.col(f"cut.{c}").alias(f"cut{c}") for c in _ORDER),
        F.coalesce("cut.part", F.lit(0)).cast("long").alias("part"),
        (F.col("cut.part") * 2 >= F.col("cut.size")).cast("long").alias("_half"),
    )
    plan = stage(plan, "cuts")
    ties = rows.join(plan.select("_source", *(f"cut{c}" for c in _ORDER)), "_source").where((_place(_ORDER[:-1]) == 0) & (F.col("_row") < F.col("cut_row")))
    plan = plan.join(ties.groupBy("_source").agg(F.count("*").alias("_before")), "_source", "left")
    plan = plan.withColumn("cut_keep", F.coalesce("_before", F.lit(0)) + F.coalesce("_half", F.lit(0))).drop("_half", "_before")
    return rows, stage(plan, "mixture")


def _place(order: Sequence[str] = _ORDER) -> Column:
    """-1 before the source's cut, 0 at it, 1 after it (or where there is none)."""
    at, cut = F.struct(*order), F.struct(*(F.col(f"cut{c}").alias(c) for c in order))
    return F.when(F.col("cut_order").isNull(), 1).when(at < cut, -1).when(at == cut, 0).otherwise(1)


def taken_words(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``taken`` for the rows of :func:`mixture`: words that the mix takes, repeats counted, cut at the exact budget."""
    more = F.when(_place() == -1, F.col("size")).when(_place() == 0, F.least("part", "size")).otherwise(0)
    return rows.join(plan, "_source").withColumn("taken", (F.col("whole") * F.col("size") + more).cast("long"))


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """The mixed table: every row as often as the mix takes it, with the columns of ``docs``.

    The document at a source's cut stays whole: it is taken if at least half of it is within the budget. Texts are not
    shuffled: the rule of a source is one row, and :func:`mixture` has the empty, null and repeated cases. Only rows with the key and
    text of a cut are staged, as they are counted. Runs its jobs when called.
    """
    _, plan = mixture(docs, key, text, source, **settings)
    names = [docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*names, *(c.alias(n) for n, c in _keyed(docs, key, text, source).items())).join(plan, "_source")
    rows = rows.withColumn("_place", _place(_ORDER[:-1]))
    kept = [f"c{i}" for i in range(len(docs.columns))]
    ties = rows.where("_place = 0").select(*kept, "_source", "whole", "cut_keep", F.monotonically_increasing_id().alias("_row"), F.lit(1).alias("_one"))
    ties = running_totals(in_blocks(ties, ["_source"], [F.col("_row")]), ["_source"], [F.col("_row")], ["_one"])
    ties = ties.select(*kept, (F.col("whole") + (F.col("cum__one") <= F.col("cut_keep")).cast("int")).cast("int").alias("_times"))
    others = rows.where("_place <> 0").select(*kept, (F.col("whole") + (F.col("_place") == -1).cast("int")).cast("int").alias("_times"))
    rows = others.unionByName(ties).where("_times > 0")
    rows = rows.withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return rows.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
