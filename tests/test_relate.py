from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowlens.operators import profile, relate


def make(spark):
    parent = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "k int, p string")
    first = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, f string")
    second = spark.createDataFrame([(1, 10), (1, 20), (1, 30), (3, 40)], "k int, s int")
    return parent, first, second


def test_children_multiply_per_parent_and_parents_without_children_vanish(spark):
    parent, first, second = make(spark)
    joined = relate.join_all(parent, [first, second], "k")
    assert joined.columns == ["k", "p", "f", "s"]
    assert Counter(r.k for r in joined.collect()) == {1: 6}


def same(one, other):
    assert one.columns == other.columns and one.count() == other.count()
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


@pytest.fixture()
def plain_joins(spark):
    """No broadcast of a side and no merging of small partitions, so that a task's rows are a partition's."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def test_hot_children_are_divided_and_nothing_changes(plain_joins):
    spark = plain_joins
    parent = spark.range(200).withColumnRenamed("id", "k").withColumn("p", F.col("k") * 2)
    child = spark.range(90_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3000 == 1, None).otherwise(F.col("id") % 150).alias("k"), F.col("id").alias("c")
    )
    joined = relate.join_children(parent, child, "k", least=500)
    same(joined, parent.join(child, "k"))
    tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) < 0.12 * sum(tasks)


def test_a_key_with_few_rows_and_most_pairs_is_divided(plain_joins):
    """0.9 % of the rows of either child have one key, which makes nearly all pairs."""
    spark = plain_joins
    side = lambda c: spark.range(200_000, numPartitions=8).select(F.when(F.col("id") < 1800, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias(c))
    joined = relate.join_pairs(side("x"), side("y"), "k")
    tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 1800**2 + 198_200 and max(tasks) < 0.15 * sum(tasks)
    hot = joined.where("k = -1").agg(F.countDistinct("x", "y"), F.count("*")).first()
    assert tuple(hot) == (1800**2, 1800**2)


def test_three_children_with_equal_rows_and_null_keys(plain_joins):
    spark = plain_joins
    parent = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (4, "w")], "k int, p string")
    rows = [(1, "a")] * 40 + [(2, "b")] * 3 + [(None, "c")] * 5
    children = [spark.createDataFrame(rows, f"k int, {c} string").repartition(5) for c in ("f", "s", "t")]
    joined = relate.join_all(parent, children, "k", least=10)
    assert joined.columns == ["k", "p", "f", "s", "t"]
    assert {(r.k, r["count"]) for r in joined.groupBy("k").count().collect()} == {(1, 40**3), (2, 27)}
    assert relate.join_all(parent, [c.where("k > 9") for c in children], "k").isEmpty()
    keyed = spark.createDataFrame([(k, {"m": k or 0}, f"{k}") for k, _ in rows], "k int, m map<string, int>, u string")
    texts = relate.join_pairs(keyed.withColumnRenamed("u", "v").drop("m"), keyed, "k", least=10)
    assert texts.count() == 40**2 + 9


def test_weights_give_the_frequencies_of_the_pairs(spark):
    parent, first, second = make(spark)
    pairs = relate.join_all(parent, [first, second], "k")
    weighted = relate.fanout_weights(parent, {"first": first, "second": second}, "k")
    for name, column in (("", "p"), ("first", "f"), ("second", "s")):
        expected = {(r.value, r.n) for r in profile.category_counts(pairs, [column]).collect()}
        found = {(r.value, r.n) for r in profile.category_counts(weighted[name], [column], "weight").collect()}
        assert found == expected


def test_look_up_with_hot_and_missing_keys(spark):
    rows = spark.range(3000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"), "id"
    )
    table = spark.createDataFrame([("hot", 1), ("4", 2), ("unused", 3)], "k string, v int")
    plain = rows.join(table, "k", "left")
    for hot in ((), ("hot",), ("hot", "4")):
        found = relate.look_up(rows, table, "k", hot, splits=3)
        assert found.columns == ["k", "id", "v"] and found.count() == 3000
        assert found.exceptAll(plain).isEmpty()
