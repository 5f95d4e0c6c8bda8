"""Hand-made rows for cleaning, one aim each."""

import datetime

from pyspark.sql import functions as F

from rowlens.functions.columns import AGE_BOUNDS
from rowlens.operators import clean


def values(df, column):
    return [row[column] for row in df.orderBy("id").collect()]


def test_sentinel_is_blanked_by_type_and_only_where_listed(spark):
    day = datetime.date(2005, 1, 4)
    df = spark.createDataFrame(
        [(1, -1, -1.0, "-1", day, -1.0), (2, 3, 2.5, "x", day, -1.0), (3, None, None, None, None, None)],
        "id int, i int, d double, s string, day date, coordinate double",
    )
    out = clean.sentinel_to_null(df, ["i", "d", "s", "day"])
    assert values(out, "i") == [None, 3, None]
    assert values(out, "d") == [None, 2.5, None]
    assert values(out, "s") == [None, "x", None]
    assert values(out, "day") == [day, day, None]
    assert values(out, "coordinate") == [-1.0, -1.0, None]


def test_dates(spark):
    df = spark.createDataFrame(
        [(1, "04/01/2005", "17:42"), (2, "31/02/2005", "17:42"), (3, "04/01/2005", None), (4, "rubbish", "x")],
        "id int, Date string, Time string",
    )
    out = clean.add_epoch(df, "Date", "Time", "Date")
    assert out.columns == ["id", "Date"]
    assert values(out, "Date") == [1104860520, None, None, None]


def test_only_nulls_in_listed_columns_drop_a_row(spark):
    df = spark.createDataFrame([(1, None, 1), (2, 1, None), (3, 1, 1)], "id int, a int, b int")
    assert values(clean.filter_not_null(df, ["a"]), "id") == [2, 3]


def test_not_null_reaches_both_scans_below_a_join(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey)
    plan = clean.filter_not_null(joined, ["o_orderstatus", "l_returnflag"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(o_orderstatus)" in text and "IsNotNull(l_returnflag)" in text


def test_null_fractions_and_sparse_columns(spark):
    df = spark.createDataFrame([(1, None, 1), (2, None, None), (3, 1, 1), (4, None, 2)], "id int, a int, b int")
    found = {r.attribute: r.null_fraction for r in clean.null_fractions(df).collect()}
    assert found == {"id": 0.0, "a": 0.75, "b": 0.25}
    assert clean.drop_sparse(df, 0.5).columns == ["id", "b"]


def test_conditional_fill(spark):
    df = spark.createDataFrame([(1, None, 0), (2, None, 3), (3, 2, 0)], "id int, control int, location int")
    assert values(clean.fill_when(df, "control", F.col("location") == 0, 0), "control") == [0, None, 2]


def test_mean_of_an_integer_column_is_truncated(spark):
    for ages, filled in (([30, None, 41, 40], 37), ([30, None, 41], 35)):
        df = spark.createDataFrame(list(enumerate(ages)), "id int, age int")
        assert values(clean.fill_means(df, ["age"]), "age")[1] == filled
        assert clean.fill_means(df, ["age"]).schema["age"].dataType.simpleString() == "int"


def test_band_of_the_mean_fills_a_banded_column(spark):
    df = spark.createDataFrame([(1, 30, 6), (2, None, None), (3, 41, 7)], "id int, age int, band int")
    out = clean.fill_means(df, ["age"], {"band": ("age", AGE_BOUNDS)})
    assert values(out, "band") == [6, 6, 7]


def test_fill_constants_keeps_types(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1, "x")], "id int, a int, s string")
    out = clean.fill_constants(df, {"a": 9, "s": "none"})
    assert values(out, "a") == [9, 1] and values(out, "s") == ["none", "x"]


def test_bands(spark):
    ages = [5, 6, 10, 10.5, 11, 15, 16, 20, 21, 25, 26, 35, 36, 45, 46, 55, 56, 65, 66, 75, 76, None]
    bands = [1, 2, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6, 7, 7, 8, 8, 9, 9, 10, 10, 11, None]
    df = spark.createDataFrame([(i, None if a is None else float(a)) for i, a in enumerate(ages)], "id int, age double")
    assert values(clean.add_band(df, "age", AGE_BOUNDS, "band"), "band") == bands


def test_decoding_keeps_unknown_codes_and_nulls(spark):
    df = spark.createDataFrame([(1, "2"), (2, "97"), (3, "77"), (4, None)], "id int, code string")
    labels = {"2": "motorcycle", "97": "motorcycle"}
    expected = ["motorcycle", "motorcycle", "77", None]
    assert values(clean.decode_values(df, {"code": labels, "absent": labels}), "code") == expected
    dictionary = spark.createDataFrame([(2, "motorcycle"), (97, "motorcycle"), (97, "motorcycle")], "c int, l string")
    assert values(clean.decode_join(df, "code", dictionary, "c", "l", "out"), "out") == expected


def test_binarize(spark):
    df = spark.createDataFrame([(1, "1"), (2, "3"), (3, "text")], "id int, severity string")
    assert values(clean.binarize(df, "severity", "1", "y"), "y") == [0, 1, 1]


def test_project_ignores_unknown_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, `a-b` int, `c (d)` int")
    out = clean.project(df, rename={"c (d)": "c"}, drop=["a-b", "nothing"])
    assert out.columns == ["id", "c"] and out.first().c == 3
