import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowlens.operators import infogain, profile
from rowlens.operators.ordered import in_blocks, running_totals


def test_describe(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, None)], "a int, b double")
    rows = {r.attribute: r for r in profile.describe_numeric(df, ["a", "b"]).collect()}
    assert (rows["a"].n, rows["a"].mean, rows["a"].stddev, rows["a"].min, rows["a"].max) == (3, 2.0, 1.0, 1.0, 3.0)
    assert (rows["b"].n, rows["b"].mean) == (2, 3.0)


def test_pairs_with_a_null_are_skipped(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a double, b double")
    assert profile.covariance_pairs(df, ["a", "b"]).first().covariance == pytest.approx(np.cov([1, 2, 4], [2, 4, 8])[0, 1])
    cells = {(r.row_attr, r.col_attr): r.correlation for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert cells[("a", "b")] == pytest.approx(1.0) and cells[("a", "a")] == 1.0


@pytest.mark.parametrize("k", [5, 14])
def test_correlation_of_few_and_many_columns(spark, k):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 1))
    x = base + rng.normal(size=(300, k)) * np.linspace(0.1, 3, k) + 1e6
    x[:, 1] = 7.0
    rows = [[None if (i + j) % 17 == 0 else float(v) for j, v in enumerate(row)] for i, row in enumerate(x)]
    columns = [f"c-{j}" for j in range(k)]
    df = spark.createDataFrame(rows, columns).repartition(3)
    cells = {(r.row_attr, r.col_attr): r.correlation for r in profile.correlation_matrix(df, columns).collect()}
    assert len(cells) == k * k
    for i in range(k):
        for j in range(k):
            both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
            found = cells[(columns[i], columns[j])]
            if 1 in (i, j):
                assert found is None
            else:
                a, b = np.array(both).T
                assert found == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-8)
                assert found == cells[(columns[j], columns[i])]
    wide = profile.correlation_wide(profile.correlation_matrix(df, columns), columns)
    assert wide.columns == ["row_attr", *columns] and wide.count() == k


def test_decoded_counts_add_codes_with_one_label(spark):
    df = spark.createDataFrame([("2",), ("97",), ("77",), (None,)], "v string")
    counts = profile.decoded_counts(df, ["v"], {"v": {"2": "motorcycle", "97": "motorcycle"}})
    assert {(r.value, r.n) for r in counts.collect()} == {("motorcycle", 2), ("77", 1), (None, 1)}


def test_crosstab_has_a_column_for_a_class_that_never_occurs(spark):
    df = spark.createDataFrame([("0.0", 0), ("0.0", 1), ("0.0", 1)], "prediction string, y int")
    row = profile.crosstab(df, "prediction", "y", ["0", "1", "2"]).first()
    assert (row.y_0, row.y_1, row.y_2) == (1, 2, 0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 20.0), ("b", 19.9), ("b", None), (None, 3.0)], "g string, x double")
    rows = profile.histogram_by_group(df, "x", "g").collect()
    assert len(rows) == 40 and sum(r.n for r in rows) == 3
    assert {(r.group, r.bin): r.n for r in rows if r.n} == {("a", 0): 1, ("a", 19): 1, ("b", 19): 1}
    same = profile.histogram_by_group(spark.createDataFrame([("a", 5.0)] * 3, "g string, x double"), "x", "g").collect()
    assert [(r.bin, r.lower, r.upper, r.n) for r in same] == [(0, 5.0, 5.0, 3)]


def test_running_totals_across_many_ranges(spark):
    rng = random.Random(3)
    rows = [(g, v, rng.randrange(9)) for g in "abc" for v in range(400 if g != "c" else 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v long, n long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = in_blocks(df, ["g"], [F.col("v").desc()])
        assert blocks.select("_block").distinct().count() > 2
        out = running_totals(blocks, ["g"], [F.col("v").desc()], ["n"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(out) == len(rows)
    for r in out:
        assert r.cum_n == sum(n for g, v, n in rows if g == r.g and v >= r.v)
        assert r.all_n == sum(n for g, v, n in rows if g == r.g)


def h(counts):
    total = sum(counts)
    return -sum(c / total * math.log2(c / total) for c in counts if c)


def brute_nominal(pairs):
    n = len(pairs)
    groups = {}
    for v, y in pairs:
        groups.setdefault(v, []).append(y)
    label = h([sum(y for _, y in pairs), sum(1 - y for _, y in pairs)])
    inside = sum(len(g) / n * h([sum(g), len(g) - sum(g)]) for g in groups.values())
    return (label - inside) / h([len(g) for g in groups.values()])


def brute_ordered(pairs):
    return max(brute_nominal([(v <= at, y) for v, y in pairs]) for at in sorted({v for v, _ in pairs})[:-1])


def test_entropy(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "a", None), (4, "a", "y")], "u int, c string, n string")
    found = {r.attribute: r.entropy for r in infogain.entropy(df, ["u", "c", "n"]).collect()}
    assert found["u"] == 2.0 and found["c"] == 0.0 and found["n"] == pytest.approx(h([1, 2]))


def ranked(spark, rows, schema, **roles):
    df = spark.createDataFrame(rows, schema)
    return {r.attribute: r.gain_ratio for r in infogain.gain_ratio_table(df, "y", 1, digits=None, **roles).collect()}


def test_gain_ratio_edges(spark):
    rows = [(0, 1, "c", 5, "u", None), (0, 2, "c", 5, "u", None), (1, 3, "c", 5, "v", None), (1, 4, "c", 5, None, None)]
    found = ranked(
        spark,
        rows,
        "y int, o int, c string, single int, holes string, empty string",
        nominal=["y", "c", "holes", "empty"],
        ordered=["o", "single"],
    )
    assert found["y"] == pytest.approx(1.0) and found["o"] == pytest.approx(1.0)
    assert found["c"] is None and found["single"] is None and found["empty"] is None
    assert found["holes"] == pytest.approx(brute_nominal([("u", 0), ("u", 0), ("v", 1)]))


def test_gain_ratio_against_a_loop(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(500):
        y = rng.randrange(2)
        rows.append((y, rng.choice("abcd") + str(y and rng.randrange(3)), rng.gauss(y, 1.0), rng.randrange(60) + 3 * y))
    found = ranked(spark, rows, "y int, cat string, x double, i long", nominal=["cat"], ordered=["x", "i"])
    assert found["cat"] == pytest.approx(brute_nominal([(r[1], r[0]) for r in rows]), abs=1e-12)
    assert found["x"] == pytest.approx(brute_ordered([(r[2], r[0]) for r in rows]), abs=1e-12)
    assert found["i"] == pytest.approx(brute_ordered([(r[3], r[0]) for r in rows]), abs=1e-12)


def test_large_integers_keep_their_order(spark):
    start = 2**60
    rows = [(0, start), (0, start + 1), (1, start + 2), (1, start + 3)]
    assert ranked(spark, rows, "y int, big long", ordered=["big"])["big"] == pytest.approx(1.0)


def test_weights_stand_for_rows(spark):
    rows = [(0, "a", 1, 3), (1, "a", 2, 1), (1, "b", 3, 2)]
    df = spark.createDataFrame(rows, "y int, c string, o int, w int")
    spread = df.withColumn("copy", F.explode(F.sequence(F.lit(1), "w")))
    for weight, table in (("w", df), (None, spread)):
        scores = infogain.gain_ratio_table(table, "y", 1, ["c"], ["o"], None, weight).collect()
        if weight:
            first = scores
        else:
            assert [tuple(r) for r in scores] == [tuple(r) for r in first]


def test_covariances_keep_every_pair_and_tell_nan_from_null(spark):
    nan = float("nan")
    rows = [(1.0, 2.0, None, nan), (2.0, 1.0, None, 1.0), (4.0, None, None, 2.0), (5.0, 7.0, None, 3.0)]
    for extra in (1, 4):  # 5 and 8 columns: one way of computing for every width
        columns = ["a", "b", "c", "d", *(f"e{i}" for i in range(extra))]
        df = spark.createDataFrame([(*r, *[r[0] * i for i in range(extra)]) for r in rows], ", ".join(f"{c} double" for c in columns))
        pairs = {(r.attribute_a, r.attribute_b): r.covariance for r in profile.covariance_pairs(df, columns).collect()}
        assert len(pairs) == len(columns) * (len(columns) - 1) // 2
        assert pairs["a", "b"] == pytest.approx(np.cov([1, 2, 5], [2, 1, 7])[0, 1])
        assert pairs["a", "c"] is None and np.isnan(pairs["a", "d"])
        cells = profile.correlation_matrix(df, columns).collect()
        assert len(cells) == len(columns) ** 2
        none = df.limit(0)
        assert profile.correlation_matrix(none, columns).count() == len(columns) ** 2
        assert {r.covariance for r in profile.covariance_pairs(none, columns).collect()} == {None}


def test_crosstab_all_counts_every_value(spark):
    df = spark.createDataFrame([("x", 1), ("x", 9), ("y", None), ("x", 9)], "r string, c int")
    assert {tuple(r) for r in profile.crosstab_all(df, "r", "c").collect()} == {("x", "1", 1), ("x", "9", 2), ("y", None, 1)}
