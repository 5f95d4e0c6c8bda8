"""Statistics of joined pairs against those of the joined rows."""

import math
import random

import pytest

from rowlens.operators import pairs, profile, relate

COLUMNS = ["p", "f1", "f2", "s1", "s2", "t1"]


def tables(spark, gaps=True):
    draw = random.Random(5)
    value = lambda: None if gaps and draw.random() < 0.2 else 1e7 + draw.random() * 10
    parent = spark.createDataFrame([(k, value(), "x") for k in range(40)] + [(None, 1.0, "y")], "k int, p double, other string")
    rows = lambda n: [(draw.randrange(45) if draw.random() < 0.9 else None, value(), value()) for _ in range(n)]
    first = spark.createDataFrame(rows(150), "k int, f1 double, f2 double").repartition(3)
    second = spark.createDataFrame(rows(100) + [(7, 1.0, 2.0)] * 30, "k int, s1 double, s2 double")
    third = spark.createDataFrame([(k, t) for k, t, _ in rows(90)], "k int, t1 double")
    return parent, {"first": first, "second": second, "third": third}


def close(one, other):
    assert one.keys() == other.keys() and one
    for key, values in one.items():
        for x, y in zip(values, other[key], strict=True):
            assert x == y or math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-7), (key, x, y)


def by(df, *keys):
    return {tuple(r[k] for k in keys): tuple(r[c] for c in df.columns if c not in keys) for r in df.collect()}


@pytest.mark.parametrize("gaps", [False, True])
def test_statistics_are_those_of_the_joined_rows(spark, gaps):
    parent, children = tables(spark, gaps)
    joined = relate.join_all(parent, list(children.values()), "k")
    close(by(pairs.describe_of_pairs(parent, children, "k", COLUMNS), "attribute"), by(profile.describe_numeric(joined, COLUMNS), "attribute"))
    order = ["s1", "p", "t1", "f2", "s2", "f1"]
    found = by(pairs.covariance_of_pairs(parent, children, "k", order), "attribute_a", "attribute_b")
    close(found, by(profile.covariance_pairs(joined, order), "attribute_a", "attribute_b"))
    found = by(pairs.correlation_of_pairs(parent, children, "k", order), "row_attr", "col_attr")
    close(found, by(profile.correlation_matrix(joined, order), "row_attr", "col_attr"))


def test_pairs_that_do_not_exist_and_values_that_are_not_numbers(spark):
    parent = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, p double")
    first = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, f double")
    second = spark.createDataFrame([(2, 1.0)], "k int, s double")
    found = by(pairs.covariance_of_pairs(parent, {"a": first, "b": second}, "k", ["f", "s", "p"]), "attribute_a", "attribute_b")
    assert found == {("f", "s"): (None,), ("f", "p"): (None,), ("s", "p"): (None,)}
    odd = spark.createDataFrame([(1, float("nan")), (1, 5.0), (2, 1.0)], "k int, s double")
    found = by(pairs.correlation_of_pairs(parent, {"a": first, "b": odd}, "k", ["f", "s"]), "row_attr", "col_attr")
    assert math.isnan(found["f", "s"][0]) and found["f", "f"] == (1.0,)
    described = by(pairs.describe_of_pairs(parent, {"a": first, "b": odd}, "k", ["f", "s"]), "attribute")
    assert described["f",][0] == 4 and math.isnan(described["s",][1]) and described["s",][3] == 5.0


def test_a_column_of_two_tables_is_refused(spark):
    parent, children = tables(spark)
    with pytest.raises(ValueError, match="f1"):
        pairs.describe_of_pairs(parent, {**children, "more": children["first"]}, "k", ["f1"])
