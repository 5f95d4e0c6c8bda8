"""Five binary classifiers over a feature vector."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowlens.functions.columns import name
from rowlens.session import new_folder
from rowlens.sources.files import stage

# The settings of the five models.
SETTINGS = {
    "decision_tree": (DecisionTreeClassifier, {"impurity": "entropy", "maxBins": 100, "maxDepth": 25, "seed": 123}),
    "random_forest": (
        RandomForestClassifier,
        {"impurity": "gini", "maxBins": 100, "numTrees": 25, "maxDepth": 13, "seed": 123},
    ),
    "linear_svc": (LinearSVC, {}),
    "naive_bayes": (NaiveBayes, {}),
    "gbt": (GBTClassifier, {"maxBins": 100, "maxDepth": 12, "seed": 123}),
}


def estimator(kind: str, label: str, features: str = "features", **settings: object) -> Estimator:
    """The estimator of a kind; ``settings`` replace its default settings."""
    make, defaults = SETTINGS[kind]
    return make(labelCol=label, featuresCol=features, **{**defaults, **settings})


def known_settings(kind: str, settings: Mapping[str, object]) -> dict[str, object]:
    """Those of ``settings`` that a kind has."""
    has = SETTINGS[kind][0]().hasParam
    return {key: value for key, value in settings.items() if has(key)}


#: Trees of these kinds are the same on rows and on weighted cells; a forest is not, as it draws single rows.
_BY_CELLS = ("decision_tree", "gbt")
#: Settings under which rows and weighted cells may differ.
_BY_ROWS = {"minInstancesPerNode", "subsamplingRate", "validationIndicatorCol", "weightCol", "thresholds"}
#: Fewer rows than this are fitted as they are.
CELLS_FROM = 200_000
#: And so is a fit of fewer levels in all its trees, as finding the cells takes some passes itself.
LEVELS_FROM = 40
_BINNED = "_binned_features"


class BinnedModel(Model):
    """A model of trees over the bins of each ordered feature, and the bins; it scores vectors as they are."""

    def __init__(self, features: str, attributes: Sequence[Mapping[str, object]], bounds: Mapping[int, Sequence[float]]):
        super().__init__()
        self.features, self.attributes, self.bounds, self.fitted = features, attributes, bounds, None

    def columns(self) -> list[str]:
        return [f"_bin_{i}" for i in range(len(self.attributes))]

    def bins(self, df: DataFrame) -> DataFrame:
        """Add a column for each feature: how many bounds are at or below it, or a category as it is."""
        point = vector_to_array(name(self.features))
        rows = df.withColumns({f"_raw_{i}" if i in self.bounds else f"_bin_{i}": point[i] for i in range(len(self.attributes))})
        places = list(self.bounds)
        splits = [[-math.inf, *self.bounds[i], math.inf] for i in places]
        if places:
            made = Bucketizer(splitsArray=splits, inputCols=[f"_raw_{i}" for i in places], outputCols=[f"_bin_{i}" for i in places], handleInvalid="keep")
            rows = made.transform(rows).drop(*(f"_raw_{i}" for i in places))
        return rows

    def vectors(self, binned: DataFrame) -> DataFrame:
        """Put the bins into a vector that knows its categories, and that bins are numbers."""
        kinds = {c: {"ml_attr": {**a, "name": c}} for c, a in zip(self.columns(), self.attributes, strict=True)}
        known = binned.withColumns({c: name(c).alias(c, metadata=kind) for c, kind in kinds.items()})
        return VectorAssembler(inputCols=self.columns(), outputCol=_BINNED).transform(known).drop(*self.columns())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.transform(self.vectors(self.bins(dataset))).drop(_BINNED)


def _attributes(df: DataFrame, features: str) -> list[dict]:
    """What the vector column says about each feature; nothing if it does not say."""
    told = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    entries = sorted((a["idx"], kind, a) for kind, some in told.items() for a in some)
    return [{"type": kind, **{k: v for k, v in a.items() if k not in ("idx", "name")}} for _, kind, a in entries]


def _bounds(df: DataFrame, features: str, places: Sequence[int], bins: int) -> tuple[int, dict[int, list[float]]]:
    """Number of rows, and least values of the bins of ordered features: every value of a feature that has few, else quantiles of all rows."""
    point = vector_to_array(name(features))
    cuts = F.array(*(F.lit(k / bins) for k in range(1, bins)))
    wanted = [x for i in places for x in (F.percentile_approx(point[i], cuts, 2_000).alias(f"q{i}"), F.approx_count_distinct(point[i]).alias(f"n{i}"))]
    told = df.agg(F.count("*").alias("n"), *wanted).first()
    few = [i for i in places if told[f"n{i}"] <= 1.25 * bins]
    values = df.agg(*(F.collect_set(point[i]).alias(f"v{i}") for i in few)).first() if few else {}
    bounds = {}
    for i in places:
        found = values[f"v{i}"] if i in few else []
        bounds[i] = sorted(set(found))[1:] if 0 < len(set(found)) <= bins else sorted(set(told[f"q{i}"] or []))
    return told.n, bounds


def _cells(df: DataFrame, kind: str, label: str, features: str, settings: Mapping[str, object]) -> tuple[BinnedModel, DataFrame] | None:
    """Rows counted by the bins of their features and by label, as (label, vector of bins, weight); nothing where that is not fewer by far.

    A tree tells rows apart by bins alone, so that equal cells are always in one leaf and have one residual in every round of
    boosting: the fit on weighted cells is that on all rows with these bins, with at most bins ** features cells, however many the rows.
    """
    attributes = _attributes(df, features)
    if kind not in _BY_CELLS or _BY_ROWS & settings.keys() or not attributes:
        return None
    made = estimator(kind, label, features, **settings)
    bins = made.getMaxBins()
    if made.getMaxDepth() * (made.getMaxIter() if made.hasParam("maxIter") else 1) < LEVELS_FROM:
        return None
    n, bounds = _bounds(df, features, [i for i, a in enumerate(attributes) if a["type"] == "numeric"], bins)
    model = BinnedModel(features, attributes, bounds)
    binned = model.bins(df).select(name(label), *model.columns())
    most = 2 * math.prod(len(bounds[i]) + 1 if i in bounds else a.get("num_vals", n) for i, a in enumerate(attributes))
    if n < CELLS_FROM:
        return None
    if most * 2 > n:  # there may be as many cells as rows
        most = binned.agg(F.approx_count_distinct(F.struct(*binned.columns))).first()[0]
    if most * 2 > n or most < 2 * bins:
        return None
    cells = stage(binned.groupBy(*(name(c) for c in binned.columns)).agg(F.count("*").cast("double").alias("_weight")), "cells")
    # A few MB of cells are many rounds of work, so each core gets a share.
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(most / 500_000))
    return model, model.vectors(cells.repartition(tasks, *(name(c) for c in binned.columns)))


def train(df: DataFrame, kind: str, label: str, features: str = "features", **settings: object) -> Model:
    """Fit on the rows of ``df``; the label is 0.0 or 1.0.

    A tree or boosted trees over many rows are fitted on weighted cells of :func:`_cells`, where these are fewer than half the rows.

    The training summary of some models holds the session, and a session that ever had an ``Observation`` can't be sent to tasks
    with the model. So such a model is saved in the shared folder and read back, which leaves its summary out.
    """
    rows = df.select(name(label), name(features))
    if counted := _cells(rows, kind, label, features, settings):
        binned, cells = counted
        binned.fitted = estimator(kind, label, _BINNED, **settings, weightCol="_weight").fit(cells)
        return binned
    model = estimator(kind, label, features, **settings).fit(rows)
    if not getattr(model, "hasSummary", False):
        return model
    path = new_folder(df.sparkSession, "model")
    model.save(path)
    return type(model).load(path)


def score(model: Model, df: DataFrame) -> DataFrame:
    """Add ``prediction`` and ``score``, a number that grows with the belief in label 1.

    The score is the probability where the model has one (the raw output of naive
    Bayes is not normalised and cannot be ranked), else the raw margin.
    """
    scored = model.transform(df)
    source = "probability" if "probability" in scored.columns else "rawPrediction"
    return scored.withColumn("score", vector_to_array(F.col(source))[1])


def score_all(models: Mapping[str, Model], df: DataFrame, label: str, features: str = "features") -> DataFrame:
    """(model, label, prediction, score) for each row and model, from one scan of the rows."""
    rows = df.select(name(label), name(features))
    for i, model in enumerate(models.values()):
        rows = score(model, rows).withColumnsRenamed({"prediction": f"_prediction_{i}", "score": f"_score_{i}"})
        rows = rows.drop("probability", "rawPrediction")
    told = [F.struct(F.lit(kind).alias("model"), F.col(f"_prediction_{i}").alias("prediction"), F.col(f"_score_{i}").alias("score")) for i, kind in enumerate(models)]
    return rows.select(name(label), F.inline(F.array(*told))).select("model", name(label), "prediction", "score")
