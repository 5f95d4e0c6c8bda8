"""The full path from related raw tables to statistics, outliers and evaluated models.

A ``Study`` says what the columns mean; the functions below turn it into Spark plans.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowlens.functions.columns import name
from rowlens.operators import clean, cluster, features, infogain, profile, relate, sampling
from rowlens.operators.classify import SETTINGS, known_settings, score_all, train
from rowlens.operators.evaluate import evaluate_by
from rowlens.sources.files import stage


@dataclass(frozen=True)
class ConditionalFill:
    """Fill nulls of ``column`` with ``value`` where ``other`` equals ``other_value``."""

    column: str
    other: str
    other_value: object
    value: object

    def condition(self) -> Column:
        return name(self.other) == F.lit(self.other_value)


@dataclass(frozen=True)
class Study:
    """The meaning of a set of related tables."""

    key: str
    label: str
    label_source: str
    label_zero: str
    ordered: Sequence[str]
    nominal: Sequence[str]
    numeric: Sequence[str]
    row_key: Sequence[str]
    date: str | None = None
    time: str | None = None
    sentinel: str = "-1"
    sentinel_columns: Sequence[str] = ()
    located_by: Sequence[str] = ()
    sparse: Sequence[str] = ()
    complete: Sequence[str] = ()
    renamed: Mapping[str, str] = field(default_factory=dict)
    conditional_fills: Sequence[ConditionalFill] = ()
    constant_fills: Mapping[str, object] = field(default_factory=dict)
    mean_fills: Sequence[str] = ()
    band_fills: Mapping[str, tuple[str, Sequence[float]]] = field(default_factory=dict)
    strata: str | None = None
    fractions: Mapping[str, float] = field(default_factory=dict)
    pruned: Sequence[str] = ()
    codebook: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    histograms: Sequence[tuple[str, str, Sequence[str]]] = ()
    seed: int = 1234
    train_share: float = 0.8
    bins: int = 100


def clean_table(study: Study, table: DataFrame) -> DataFrame:
    """What can be done before the joins: drop sparse columns, blank the sentinel, drop incomplete rows.

    Rows that cannot survive are gone before they are shuffled and multiplied.
    """
    kept = table.drop(*study.sparse)
    blanked = clean.sentinel_to_null(kept, study.sentinel_columns, study.sentinel)
    filled_later = {fill.column for fill in study.conditional_fills}
    required = [
        c for c in (*study.located_by, *study.complete) if c in kept.columns and c not in filled_later
    ]
    return clean.filter_not_null(blanked, required) if required else blanked


def join_tables(study: Study, parent: DataFrame, children: Iterable[DataFrame]) -> DataFrame:
    """One row per combination of child rows of the same parent, as the study's unit of analysis."""
    if study.date and study.time:
        parent = clean.add_epoch(parent, study.date, study.time, study.date)
    return relate.join_all(clean_table(study, parent), [clean_table(study, child) for child in children], study.key)


def clean_rows(study: Study, joined: DataFrame) -> DataFrame:
    """Fill by condition, drop the rows that are still incomplete, rename."""
    df = joined
    for fill in study.conditional_fills:
        df = clean.fill_when(df, fill.column, fill.condition(), fill.value)
    if study.complete:
        df = clean.filter_not_null(df, study.complete)
    return clean.project(df, rename=study.renamed)


def fill_rows(study: Study, cleaned: DataFrame, means: Column | None = None) -> DataFrame:
    """Impute, turn codes into categories and add the binary label.

    Without ``means`` they are a subquery over ``cleaned``; a plan that joins runs once more for them, with no columns but theirs.
    """
    df = cleaned
    if study.mean_fills or study.band_fills:
        df = clean.fill_means(df, study.mean_fills, study.band_fills, means)
    df = clean.fill_constants(df, study.constant_fills)
    df = clean.to_nominal(df, study.nominal)
    return clean.binarize(df, study.label_source, study.label_zero, study.label)


def sample_rows(study: Study, rows: DataFrame) -> DataFrame:
    """The stratified sample, by a hash of the row key."""
    if study.strata is None:
        return rows
    return sampling.stratified_sample_hash(rows, study.strata, study.fractions, study.row_key, study.seed)


def prepare(study: Study, parent: DataFrame, children: Iterable[DataFrame]) -> DataFrame:
    """Joined, cleaned, filled and sampled rows, over a staged table.

    Only the sample is written: it is taken in the stage that joins, and the joined pairs, of which there may be very many more, are not stored.
    The means of all pairs are observed as they pass by, in that same stage, so the joins run once. Where the sample depends on a
    filled column, rows are filled first, with means from a plan of their own.
    """
    cleaned = clean_rows(study, join_tables(study, parent, children))
    sources = clean.mean_sources(study.mean_fills, study.band_fills)
    filled = {*study.mean_fills, *study.band_fills, *study.constant_fills}
    if not sources or filled & {study.strata, *study.row_key}:
        return stage(sample_rows(study, fill_rows(study, cleaned)), "prepared")
    seen = Observation()
    passing = cleaned.observe(seen, *(F.avg(name(c)).alias(f"m{i}") for i, c in enumerate(sources)))
    sample = stage(sample_rows(study, passing), "prepared")
    means = F.struct(*(F.lit(seen.get[f"m{i}"]).cast("double").alias(c) for i, c in enumerate(sources)))
    return fill_rows(study, sample, means)


def feature_columns(study: Study) -> list[str]:
    gone = {*study.pruned, study.label}
    return [c for c in (*study.ordered, *study.nominal) if c not in gone]


def index_rows(study: Study, prepared: DataFrame) -> DataFrame:
    """The model columns: ordered ones as they are, nominal ones as category indexes, and the label.

    A nominal column with more values than ``study.bins`` is ranked by label, on the rows that models are trained on.
    """
    kept = feature_columns(study)
    nominal = [c for c in study.nominal if c in kept]
    wanted = dict.fromkeys([*study.row_key, *study.numeric, *kept])
    columns = prepared.select(*(name(c) for c in wanted), name(study.label).cast("double").alias(study.label))
    training, _ = sampling.split_hash(columns, study.train_share, study.row_key, study.seed)
    return features.code_categories(columns, training, nominal, study.label, 1, study.bins)


def vectorize(study: Study, indexed: DataFrame) -> DataFrame:
    """Add the feature vector and stage the result, which every model fit reads many times."""
    return stage(features.assemble(indexed, feature_columns(study)), "features", study.row_key)


def statistics(study: Study, prepared: DataFrame, indexed: DataFrame) -> dict[str, DataFrame]:
    """Summary, covariance, gain ratio and correlation tables."""
    kept = feature_columns(study)
    ordered = [c for c in study.ordered if c in kept]
    nominal = [c for c in study.nominal if c in kept]
    return {
        "describe": profile.describe_numeric(prepared, study.numeric),
        "covariance": profile.covariance_pairs(prepared, study.numeric),
        "gain_ratio": infogain.gain_ratio_table(prepared, study.label, 1, [*nominal, study.label], ordered),
        "correlation": profile.correlation_matrix(indexed, [*kept, study.label]),
    }


def charts(study: Study, prepared: DataFrame) -> dict[str, DataFrame]:
    """The tables behind bar charts (decoded frequencies) and histograms."""
    columns = [c for c in study.codebook if c in prepared.columns]
    tables = {"categories": profile.decoded_counts(prepared, columns, study.codebook)}
    for value, group, groups in study.histograms:
        title = f"{value} by {group} {'/'.join(groups)}"
        tables[title] = profile.histogram_by_group(prepared, value, group, groups)
    return tables


def find_outliers(study: Study, vectors: DataFrame, only_numeric: bool = False) -> DataFrame:
    """The rows farthest from their k-means centre, on all features or on the numeric columns."""
    if only_numeric:
        vectors = features.assemble(vectors.drop("features"), study.numeric)
    return cluster.outliers(cluster.assign(cluster.fit_kmeans(vectors, seed=study.seed), vectors), ties=study.row_key)


def evaluate_models(
    study: Study,
    vectors: DataFrame,
    kinds: Sequence[str] = tuple(SETTINGS),
    positive: int = 1,
    by_kind: Mapping[str, Mapping[str, object]] | None = None,
    **settings: object,
) -> DataFrame:
    """Train each kind on the train rows and evaluate it on the test rows; one row per model.

    ``settings`` go to the kinds that have them, ``by_kind`` to the kind it names. A setting that no chosen kind has is an error.
    """
    if unknown := [key for key in settings if not any(known_settings(kind, {key: 0}) for kind in kinds)]:
        raise TypeError(f"no chosen model has the settings {unknown}")
    training, testing = sampling.split_hash(vectors, study.train_share, study.row_key, study.seed)
    models = {kind: train(training, kind, study.label, **{**known_settings(kind, settings), **(by_kind or {}).get(kind, {})}) for kind in kinds}
    scored = score_all(models, testing, study.label)
    if positive == 0:
        scored = scored.withColumn("score", -F.col("score"))
    place = F.array_position(F.array(*(F.lit(kind) for kind in kinds)), F.col("model"))
    return evaluate_by(scored, "model", study.label, positive).orderBy(place)


def run(study: Study, parent: DataFrame, children: Iterable[DataFrame], **settings: object) -> dict[str, DataFrame]:
    """Every result of the study by name."""
    prepared = prepare(study, parent, children)
    indexed = index_rows(study, prepared)
    vectors = vectorize(study, indexed)
    return {
        "prepared": prepared,
        **statistics(study, prepared, vectors),
        **charts(study, prepared),
        "outliers": find_outliers(study, vectors),
        "models": evaluate_models(study, vectors, **settings),
    }
