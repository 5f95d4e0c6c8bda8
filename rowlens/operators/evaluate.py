"""Confusion counts, derived metrics and the exact area under the ROC curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlens.functions.columns import equals, name, ratio
from rowlens.operators.ordered import in_blocks, running_totals

_CELLS = ("tp", "fn", "fp", "tn")


def _cells(actual: Column, predicted: Column, n: Column) -> list[Column]:
    conditions = (actual & predicted, actual & ~predicted, ~actual & predicted, ~actual & ~predicted)
    return [
        F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("bigint").alias(cell)
        for cell, condition in zip(_CELLS, conditions, strict=True)
    ]


def _metrics() -> list[Column]:
    """Rates of the four counts; a rate without any case is null."""
    tp, fn, fp, tn = (F.col(c) for c in _CELLS)
    total = tp + fn + fp + tn
    return [
        *(F.col(c) for c in _CELLS),
        ratio(tp + tn, total).alias("accuracy"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(fp + fn, total).alias("error"),
    ]


def confusion_metrics(
    predictions: DataFrame, label: str, positive: object, prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """One row: the four counts and accuracy, recall, precision, F1 and error.

    Cells are counted by value, never by their position in a table, so a class that
    is never predicted simply counts 0.
    """
    n = name(weight) if weight else F.lit(1)
    return predictions.agg(*_cells(equals(label, positive), equals(prediction, positive), n)).select(*_metrics())


def _area(running: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of (positive, negative) pairs in which the positive scores higher; ties count half.

    Reads per-score counts ``pos`` and ``neg`` with running sums; no pair is formed.
    """
    below = F.col("cum_neg") - F.col("neg")
    won = F.sum(F.col("pos").cast("double") * (below.cast("double") + F.col("neg") / F.lit(2.0)))
    area = running.groupBy(*by).agg(
        won.alias("won"), F.max("all_pos").cast("double").alias("p"), F.max("all_neg").cast("double").alias("q")
    )
    return area.select(*by, ratio(F.col("won"), F.col("p") * F.col("q")).alias("auc"))


def auc_roc(
    predictions: DataFrame, label: str, positive: object, score: str = "score", weight: str | None = None
) -> DataFrame:
    """Exact area under the ROC curve; null if a class is absent."""
    actual, n = equals(label, positive), name(weight) if weight else F.lit(1)
    counts = (
        predictions.filter(name(score).isNotNull() & name(label).isNotNull())
        .groupBy(name(score).cast("double").alias("score"))
        .agg(
            F.sum(F.when(actual, n).otherwise(0)).cast("bigint").alias("pos"),
            F.sum(F.when(~actual, n).otherwise(0)).cast("bigint").alias("neg"),
        )
    )
    order = [F.col("score")]
    return _area(running_totals(in_blocks(counts, [], order), [], order, ["pos", "neg"]))


def evaluate(
    predictions: DataFrame, label: str, positive: object = 1, prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """One row with the confusion counts, the metrics and ``auc``.

    The model scores each row once: the rows are reduced to counts per score, which
    feed both parts. ``score`` must grow with the belief in the positive class.
    """
    actual, predicted = equals(label, positive), equals(prediction, positive)
    rows = predictions.filter(name(label).isNotNull())
    counts = rows.groupBy(name(score).cast("double").alias("score")).agg(*_cells(actual, predicted, F.lit(1)))
    per_score = counts.withColumns({"pos": F.col("tp") + F.col("fn"), "neg": F.col("fp") + F.col("tn")})
    blocks = in_blocks(per_score, [], [F.col("score")])
    confusion = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _CELLS)).select(*_metrics())
    area = _area(running_totals(blocks.filter(F.col("score").isNotNull()), [], [F.col("score")], ["pos", "neg"]))
    return confusion.withColumn("auc", area.scalar())


def evaluate_by(
    predictions: DataFrame, by: str, label: str, positive: object = 1, prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """A row like that of :func:`evaluate` for each value of ``by``, such as the model that scored the row.

    All rows are reduced to counts per (by, score) at once, and one range-cut ranking by (by, score) gives every area. A value
    of ``by`` with no labelled row has no row here.
    """
    actual, predicted = equals(label, positive), equals(prediction, positive)
    rows = predictions.filter(name(label).isNotNull())
    counts = rows.groupBy(name(by).alias("_by"), name(score).cast("double").alias("score")).agg(*_cells(actual, predicted, F.lit(1)))
    per_score = counts.withColumns({"pos": F.col("tp") + F.col("fn"), "neg": F.col("fp") + F.col("tn")})
    blocks = in_blocks(per_score, ["_by"], [F.col("score")])
    confusion = blocks.groupBy("_by").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _CELLS)).select("_by", *_metrics())
    area = _area(running_totals(blocks.filter(F.col("score").isNotNull()), ["_by"], [F.col("score")], ["pos", "neg"]), ["_by"])
    return confusion.join(area, "_by", "left").withColumnRenamed("_by", by)
