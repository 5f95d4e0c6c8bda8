import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rowlens.operators import classify, cluster, evaluate, features, sampling

# Published counts (tp, fn, fp, tn) of five models with their accuracy, recall, precision, F1 and error.
PUBLISHED = {
    "decision tree": ((13118, 3630, 2248, 14203), (0.8229, 0.7833, 0.8537, 0.8170, 0.1771)),
    "random forest": ((13257, 3491, 2674, 13777), (0.8143, 0.7916, 0.8322, 0.8113, 0.1857)),
    "boosted trees": ((13355, 3393, 2393, 14058), (0.8257, 0.7974, 0.8480, 0.8219, 0.1743)),
    "naive Bayes": ((11655, 5093, 4428, 12023), (0.7132, 0.6959, 0.7247, 0.7100, 0.2868)),
    "linear SVM": ((12093, 4655, 3853, 12598), (0.7437, 0.7221, 0.7584, 0.7398, 0.2563)),
}


@pytest.mark.parametrize("model", PUBLISHED)
def test_metrics_of_published_counts(spark, model):
    (tp, fn, fp, tn), expected = PUBLISHED[model]
    # Index 0.0 is the positive class there.
    rows = [(0.0, 0.0, tp), (1.0, 0.0, fn), (0.0, 1.0, fp), (1.0, 1.0, tn)]
    df = spark.createDataFrame(rows, "prediction double, label double, w int")
    row = evaluate.confusion_metrics(df, "label", 0, weight="w").first()
    found = (row.accuracy, row.recall, row.precision, row.f1, row.error)
    assert tuple(round(v, 4) for v in found) == expected


def test_a_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 1, 0.3), (0.0, 0, 0.3)], "prediction double, label int, score double")
    row = evaluate.evaluate(df, "label", 1).first()
    assert (row.tp, row.fn, row.fp, row.tn) == (0, 1, 0, 1)
    assert row.precision is None and row.recall == 0.0 and row.auc == 0.5
    one = evaluate.evaluate(df.filter("label = 1"), "label", 1).first()
    assert one.auc is None


def auc(spark, rows):
    df = spark.createDataFrame(rows, "label int, score double")
    return evaluate.auc_roc(df, "label", 1).first().auc


def test_auc(spark):
    assert auc(spark, [(0, 0.1), (0, 0.2), (1, 0.3)]) == 1.0
    assert auc(spark, [(1, 0.1), (0, 0.2), (0, 0.3)]) == 0.0
    assert auc(spark, [(0, 0.5), (1, 0.5), (1, 0.9), (0, 0.1)]) == 0.875


def test_auc_agrees_with_the_evaluator(spark):
    df = spark.range(2000).select(
        (F.rand(1) < 0.4).cast("double").alias("label"), F.round(F.rand(2), 2).alias("rawPrediction")
    )
    df = df.withColumn("score", F.col("rawPrediction")).cache()
    expected = BinaryClassificationEvaluator(labelCol="label", numBins=0).evaluate(df)
    assert evaluate.auc_roc(df, "label", 1).first().auc == pytest.approx(expected, abs=1e-12)


def test_index_order_and_ties(spark):
    df = spark.createDataFrame([("c",), ("c",), ("a",), ("b",), (None,)], "v string")
    table = features.string_index_table(df, ["v"])
    assert {(r.value, r["index"]) for r in table.collect()} == {("c", 0.0), ("a", 1.0), ("b", 2.0)}
    encoded = [r.v for r in features.apply_index(df, table, ["v"]).collect()]
    assert sorted(encoded, key=str) == [0.0, 0.0, 1.0, 2.0, None]


def test_index_equals_the_builtin_indexer(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    columns = ["o_orderpriority", "o_orderstatus", "o_custkey"]
    ours = features.index_for_models(orders, columns)
    theirs = StringIndexer(inputCols=columns, outputCols=["a", "b", "c"]).fit(orders).transform(orders)
    left = ours.select("o_orderkey", *columns)
    right = theirs.select("o_orderkey", "a", "b", "c")
    assert left.exceptAll(right).isEmpty()
    assert ours.schema["o_orderstatus"].metadata["ml_attr"]["num_vals"] == len(theirs.schema["b"].metadata["ml_attr"]["vals"])


def test_model_index_of_very_many_values_and_of_none(spark):
    df = spark.range(5_000).select(F.col("id").cast("string").alias("v"), F.lit(None).cast("string").alias("none"))
    indexed = features.index_for_models(df, ["v", "none"])
    assert indexed.schema["v"].metadata["ml_attr"]["num_vals"] == 5_000 and not indexed.schema["none"].metadata
    assert indexed.agg(F.count_distinct("v"), F.min("v"), F.max("v"), F.count("none")).first() == (5_000, 0.0, 4_999.0, 0)


def test_assemble_keeps_nominal_metadata_and_odd_names(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("x", 3.0)], "`a-b (c)?` string, d double")
    indexed = features.index_for_models(df, ["a-b (c)?"])
    vectors = features.assemble(indexed, ["a-b (c)?", "d"])
    assert vectors.columns == ["a-b (c)?", "d", "features"]
    attrs = vectors.schema["features"].metadata["ml_attr"]["attrs"]
    assert attrs["nominal"][0]["num_vals"] == 2
    assert [tuple(r.v) for r in vectors.select(vector_to_array("features").alias("v")).orderBy("d").collect()] == [
        (0.0, 1.0),
        (1.0, 2.0),
        (0.0, 3.0),
    ]


def test_weak_attributes_are_dropped(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    ranking = spark.createDataFrame([("a", 0.5), ("b", 0.001), ("c", None)], "attribute string, gain_ratio double")
    assert features.select_by_gain_ratio(df, ranking, 0.01).columns == ["a"]


def test_hash_sample(spark):
    df = spark.range(20000).select(
        "id", F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").when(F.col("id") % 4 == 2, "c").alias("s")
    )
    fractions = {"a": 1.0, "b": 0.02}
    kept = sampling.stratified_sample_hash(df, "s", fractions, ["id"], 1234)
    counts = {r.s: r["count"] for r in kept.groupBy("s").count().collect()}
    assert set(counts) == {"a", "b"} and counts["a"] == 5000 and 60 < counts["b"] < 140
    again = sampling.stratified_sample_hash(df.repartition(7), "s", fractions, ["id"], 1234)
    assert kept.exceptAll(again).isEmpty() and again.exceptAll(kept).isEmpty()
    native = sampling.stratified_sample(df, "s", fractions, 1234).groupBy("s").count().collect()
    assert {r.s for r in native} == {"a", "b"}


def test_hash_split_is_a_disjoint_cover(spark):
    df = spark.range(5000)
    train, test = sampling.split_hash(df, 0.8, ["id"], 1234)
    assert train.count() + test.count() == 5000 and train.join(test, "id").isEmpty()
    assert 3800 < train.count() < 4200
    parts = sampling.random_split(df, [0.8, 0.2], 1234)
    assert sum(p.count() for p in parts) == 5000


def test_nearest_center(spark):
    df = spark.createDataFrame([(1, 3.0, 4.0), (2, 10.0, 1.0), (3, 5.0, 0.0)], "id int, x double, y double")
    rows = cluster.nearest_center(df, ["x", "y"], [(0.0, 0.0), (10.0, 0.0)]).orderBy("id").collect()
    assert [(r.center, r.distance) for r in rows] == [(0, 5.0), (1, 1.0), (0, 5.0)]


def test_kmeans_distance_is_that_of_the_nearest_center(spark):
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 0.5, size=(60, 2)) for c in (0, 5, 10)])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, x double, y double")
    vectors = features.assemble(df, ["x", "y"])
    model = cluster.fit_kmeans(vectors, k=3)
    rows = cluster.assign(model, vectors).orderBy("id").collect()
    gaps = np.linalg.norm(points[:, None, :] - np.array(model.clusterCenters())[None], axis=2)
    assert len(rows) == len(points)
    for row, gap in zip(rows, gaps, strict=True):
        assert row.distance == pytest.approx(gap.min()) and row.prediction == gap.argmin()
    far = cluster.outliers(cluster.assign(model, vectors), 5, ["id"]).collect()
    assert [r.distance for r in far] == pytest.approx(sorted(gaps.min(axis=1), reverse=True)[:5])


def test_kmeans_tasks_are_bounded_by_rows_and_width(spark, monkeypatch):
    rows = spark.range(3000).coalesce(1).select((F.col("id") % 100).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    vectors = features.assemble(rows, ["x", "y"])
    monkeypatch.setattr(cluster, "TASK_NUMBERS", 12 * 400)
    held = [len(part) for part in cluster._in_even_tasks(vectors, "features").rdd.glom().collect()]
    assert sum(held) == 3000 and len(held) == 8 and max(held) < 500
    assert sum(cluster.fit_kmeans(vectors, k=3).summary.clusterSizes) == 3000
    assert cluster._in_even_tasks(vectors.limit(0), "features").count() == 0


SMALL = {
    "decision_tree": {"maxDepth": 5},
    "random_forest": {"maxDepth": 5, "numTrees": 8},
    "linear_svc": {"maxIter": 20},
    "naive_bayes": {},
    "gbt": {"maxDepth": 3, "maxIter": 4},
}


@pytest.mark.parametrize("kind", SMALL)
def test_classifiers_find_a_real_signal(spark, sf, kind):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    sale = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    rows = lines.withColumn("y", (sale > 50000).cast("double"))
    vectors = features.assemble(
        features.index_for_models(rows, ["l_returnflag"]), ["l_extendedprice", "l_quantity", "l_discount", "l_returnflag"]
    )
    train, test = sampling.split_hash(vectors, 0.8, ["l_orderkey", "l_linenumber", "l_partkey"], 1234)
    model = classify.train(train, kind, "y", **SMALL[kind])
    row = evaluate.evaluate(classify.score(model, test), "y", 1).first()
    assert row.tp + row.fn + row.fp + row.tn == test.count()
    assert row.auc > (0.85 if kind == "naive_bayes" else 0.95)
    assert math.isclose(row.accuracy + row.error, 1.0)


@pytest.mark.parametrize("kind", SMALL)
def test_classifiers_score_in_a_session_that_observed(spark, kind):
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = spark.range(400).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"), (F.col("id") >= 200).cast("double").alias("y"))
    vectors = features.assemble(rows, ["x", "z"])
    settings = classify.known_settings(kind, {"maxDepth": 3, "numTrees": 5, "maxIter": 5, "featureSubsetStrategy": "all"})
    scored = classify.score(classify.train(vectors, kind, "y", **settings), vectors).repartition(3)
    row = evaluate.evaluate(scored, "y", 1).first()
    assert (row.tp + row.fn, row.fp + row.tn) == (200, 200)
    assert row.auc > (0.85 if kind == "naive_bayes" else 0.95)


@pytest.mark.parametrize("kind", ["decision_tree", "gbt"])
def test_trees_of_weighted_cells_are_those_of_rows(spark, monkeypatch, kind):
    rows = spark.range(6000).select(
        (F.col("id") % 23).cast("double").alias("x"), (F.col("id") % 11 / 2).alias("z"), F.concat(F.lit("c"), F.col("id") % 3).alias("c"), F.pmod(F.hash("id"), F.lit(5)).alias("u")
    )
    noisy = ((F.col("x") + 4 * F.col("z") > 20) & (F.col("c") != "c1")) != (F.col("u") == 0)
    vectors = features.assemble(features.index_for_models(rows.withColumn("y", noisy.cast("double")), ["c"]), ["x", "z", "c"]).select("y", "features")
    settings = {"maxDepth": 4, "maxBins": 32, **classify.known_settings(kind, {"maxIter": 4})}
    plain = classify.score(classify.train(vectors, kind, "y", **settings), vectors)
    monkeypatch.setattr(classify, "CELLS_FROM", 1000)
    monkeypatch.setattr(classify, "LEVELS_FROM", 1)
    model = classify.train(vectors, kind, "y", **settings)
    by_cells = classify.score(model, vectors)
    assert isinstance(model, classify.BinnedModel) and by_cells.columns == plain.columns
    assert classify._cells(vectors, kind, "y", "features", settings)[1].agg(F.sum("_weight"), F.count("*")).first()[0] == 6000
    both = [sorted((r.features.toArray().tolist(), r.prediction, round(r.score, 9)) for r in df.collect()) for df in (plain, by_cells)]
    assert both[0] == both[1]


def test_trees_of_cells_cut_many_values_by_quantiles(spark, monkeypatch):
    monkeypatch.setattr(classify, "CELLS_FROM", 1000)
    monkeypatch.setattr(classify, "LEVELS_FROM", 1)
    rows = spark.range(20000).select(F.col("id").cast("double").alias("x"), (F.col("id") >= 8000).cast("double").alias("y"))
    vectors = features.assemble(rows, ["x"])
    model = classify.train(vectors, "decision_tree", "y", maxDepth=6, maxBins=100)
    assert len(model.bounds[0]) == 99
    wrong = classify.score(model, vectors).filter(F.col("prediction") != F.col("y")).count()
    assert wrong <= 200
    unlike = features.assemble(rows.withColumn("w", F.col("x") * 3), ["x", "w"]).limit(3000)
    monkeypatch.setattr(classify, "CELLS_FROM", 4000)
    assert classify._cells(unlike, "gbt", "y", "features", {}) is None


def test_settings_are_the_published_ones():
    tree = classify.estimator("decision_tree", "y")
    assert (tree.getImpurity(), tree.getMaxBins(), tree.getMaxDepth(), tree.getSeed()) == ("entropy", 100, 25, 123)
    forest = classify.estimator("random_forest", "y")
    assert (forest.getImpurity(), forest.getNumTrees(), forest.getMaxDepth()) == ("gini", 25, 13)
    assert classify.estimator("gbt", "y").getMaxDepth() == 12


def test_redundant_attributes_are_dropped_after_better_ones(spark):
    ranking = spark.createDataFrame([("a", 0.5), ("b", 0.4), ("c", 0.4), ("d", 0.3), ("e", None), ("f", 0.01), ("g", 0.2)], "attribute string, gain_ratio double")
    cells = [("a", "c", -0.95), ("c", "d", 0.99), ("a", "f", 1.0), ("b", "g", float("nan")), ("d", "g", None), ("e", "b", 0.99), ("f", "g", 0.99)]
    both = [*cells, *((y, x, r) for x, y, r in cells), *((x, x, 1.0) for x in "abcdefg")]
    correlation = spark.createDataFrame(both, "row_attr string, col_attr string, correlation double")
    choice = features.choose_features(ranking, correlation, 0.1, 0.9)
    told = [(r.place, r.attribute, r.kept, r.reason, r.like) for r in choice.orderBy("place").collect()]
    # c goes for a, so d, which is like c alone, stays; a weak one is no reason to drop another.
    assert told == [
        (1, "a", True, None, None),
        (2, "b", True, None, None),
        (3, "c", False, "correlation", "a"),
        (4, "d", True, None, None),
        (5, "g", True, None, None),
        (6, "f", False, "gain", None),
        (7, "e", False, "gain", None),
    ]
    df = spark.createDataFrame([tuple(range(8))], "a int, b int, c int, d int, e int, f int, g int, label int")
    assert features.select_features(df, choice, keep=["f"]).columns == ["a", "b", "d", "f", "g", "label"]
    none = features.choose_features(ranking.limit(0), correlation.limit(0), 0.1, 0.9)
    assert none.count() == 0


def test_ranks_by_label_split_as_well_as_any_set_of_values(spark):
    """The best of all sets of values, tried out, is a threshold of the ranks."""
    shares = {"a": (3, 10), "b": (9, 10), "c": (1, 10), "d": (5, 10), "e": (7, 9)}
    rows = [(v, int(i < t)) for v, (t, n) in shares.items() for i in range(n)] + [(None, 1)]
    train = spark.createDataFrame(rows, "v string, label int")
    table = features.label_order_table(train, ["v"], "label", 1)
    ranks = {r.value: r["index"] for r in table.collect()}
    assert ranks == {"c": 0.0, "a": 1.0, "d": 2.0, "e": 3.0, "b": 4.0}
    assert {(r.n, r.t, r.total, r.rest) for r in table.where("value = 'e'").collect()} == {(9, 7, 49, 2.5)}

    def impurity(group):
        t, n = sum(shares[v][0] for v in group), sum(shares[v][1] for v in group)
        return n * 2 * (t / n) * (1 - t / n) if n else 0.0

    sets = [{v for i, v in enumerate(shares) if bits >> i & 1} for bits in range(1, 2 ** len(shares) - 1)]
    best = min(sets, key=lambda s: impurity(s) + impurity(shares.keys() - s))
    assert any(best in ({v for v in ranks if ranks[v] <= x}, {v for v in ranks if ranks[v] > x}) for x in ranks.values())
    df = spark.createDataFrame([("b", 1), ("new", 2), (None, 3)], "v string, id int")
    coded = features.code_by_label(df, train, ["v"], "label", 1)
    assert coded.columns == ["v", "id"] and {(r.id, r.v) for r in coded.collect()} == {(1, 4.0), (2, 2.5), (3, None)}


def test_only_columns_with_more_values_than_bins_are_ranked(spark):
    df = spark.range(600).select((F.col("id") % 150).cast("string").alias("many"), (F.col("id") % 3).cast("string").alias("few"), (F.col("id") % 150 > 75).cast("int").alias("y"))
    coded = features.code_categories(df, df, ["many", "few"], "y", 1, bins=100)
    assert coded.schema["few"].metadata["ml_attr"]["num_vals"] == 3 and "ml_attr" not in coded.schema["many"].metadata
    vectors = features.assemble(coded.withColumn("y", F.col("y").cast("double")), ["many", "few"])
    model = classify.train(vectors, "decision_tree", "y", maxDepth=1)
    # 100 bins for 150 ranks: the rows of a value beside the best threshold may be on its wrong side.
    assert model.transform(vectors).where("prediction <> y").count() <= 4


def test_models_are_reported_together_as_one_by_one(spark):
    df = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"), (F.col("id") % 20 > 12).cast("double").alias("y"))
    vectors = features.assemble(df, ["x", "z"])
    models = {"decision_tree": {"maxDepth": 2}, "naive_bayes": {}, "linear_svc": {"maxIter": 5}}
    models = {kind: classify.train(vectors, kind, "y", **settings) for kind, settings in models.items()}
    together = evaluate.evaluate_by(classify.score_all(models, vectors, "y"), "model", "y", 1)
    assert together.columns[0] == "model" and together.count() == 3
    for row in together.collect():
        alone = evaluate.evaluate(classify.score(models[row.model], vectors), "y", 1).first()
        assert tuple(row)[1:] == tuple(alone)
