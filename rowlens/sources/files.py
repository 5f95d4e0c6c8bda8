"""CSV and Parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from rowlens.session import new_folder


#: Types that a column of text may have, narrowest first; a later one of a line takes what an earlier one does.
TYPES = ("boolean", "integer", "bigint", "double", "date", "timestamp")
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$"


def _fits(text: Column) -> dict[str, Column]:
    """Whether a text is a value of each type; a clock time, a code with letters or a year alone is none of them."""
    text = F.trim(text)
    whole, date = text.rlike(r"^[+-]?[0-9]+$"), text.rlike(_DATE) & text.try_cast("date").isNotNull()
    return {
        "boolean": F.lower(text).isin("true", "false"),
        "integer": whole & text.try_cast("integer").isNotNull(),
        "bigint": whole & text.try_cast("bigint").isNotNull(),
        "double": text.rlike(_NUMBER) | text.isin("NaN", "Infinity", "-Infinity"),
        "date": date,
        "timestamp": date | (text.rlike(_MOMENT) & text.try_cast("timestamp").isNotNull()),
    }


def _raw_csv(spark: SparkSession, path: str, null_value: str) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).option("nullValue", null_value).csv(path)


def type_counts(spark: SparkSession, path: str, null_value: str = "") -> DataFrame:
    """(column, type, n, n_null, n_boolean, ...) for each column of headed CSV files: how many values fit each type, and the narrowest that all fit.

    One pass over the texts with a row of counts for each column and task; counts of other files add to them. A column without any value,
    or with values that no one type fits, is a string.
    """
    raw = _raw_csv(spark, path, null_value)
    texts = [v for i, c in enumerate(raw.columns) for v in (F.lit(i), raw[f"`{c}`"])]
    long = raw.select(F.stack(F.lit(len(raw.columns)), *texts).alias("i", "text"))
    counts = long.groupBy("i").agg(
        F.count("*").alias("n"), F.count_if(F.col("text").isNull()).alias("n_null"), *(F.count_if(fits).alias(f"n_{kind}") for kind, fits in _fits(F.col("text")).items())
    )
    given = F.col("n") - F.col("n_null")
    kind = F.coalesce(*(F.when((given > 0) & (F.col(f"n_{t}") == given), F.lit(t)) for t in TYPES), F.lit("string"))
    names = F.array(*(F.lit(c) for c in raw.columns))
    return counts.select(names[F.col("i")].alias("column"), kind.alias("type"), "n", "n_null", *(f"n_{t}" for t in TYPES))


def infer_schema(spark: SparkSession, path: str, null_value: str = "") -> StructType:
    """The schema of :func:`type_counts`, with columns in the order of the header. Runs its pass when called."""
    types = {row["column"]: row["type"] for row in type_counts(spark, path, null_value).select("column", "type").collect()}
    schema = StructType()
    for column in _raw_csv(spark, path, null_value).columns:
        schema = schema.add(column, types.get(column, "string").replace("bigint", "long"))
    return schema


def misfits(spark: SparkSession, path: str, schema: StructType, null_value: str = "") -> DataFrame:
    """(column, type, n, n_null, n_misfit): how many values :func:`scan_csv` turns null because they do not fit the declared type."""
    raw = _raw_csv(spark, path, null_value)
    told = [v for i, f in enumerate(schema) for v in (F.lit(i), raw[f"`{f.name}`"].isNotNull(), raw[f"`{f.name}`"].try_cast(f.dataType).isNotNull())]
    long = raw.select(F.stack(F.lit(len(schema)), *told).alias("i", "given", "fits"))
    counts = long.groupBy("i").agg(
        F.count("*").alias("n"), F.count_if(~F.col("given")).alias("n_null"), F.count_if(F.col("given") & ~F.col("fits")).alias("n_misfit")
    )
    names, types = (F.array(*(F.lit(x) for x in xs)) for xs in ([f.name for f in schema], [f.dataType.simpleString() for f in schema]))
    return counts.select(names[F.col("i")].alias("column"), types[F.col("i")].alias("type"), "n", "n_null", "n_misfit")


def scan_csv(spark: SparkSession, path: str, schema: StructType | None = None, null_value: str = "") -> DataFrame:
    """Read headed CSV files and bind ``schema`` by column name; without one it is inferred, by a pass of its own.

    With a schema only the header line is read up front, and text such as ``17:42`` keeps its declared type. A value that does not
    fit its type becomes null. Pruned columns are never parsed. A file of the folder whose header names other
    columns, or the same in another order, raises an error when its rows are read.
    """
    raw = _raw_csv(spark, path, null_value)
    schema = infer_schema(spark, path, null_value) if schema is None else schema
    return raw.select(
        *(
            raw[f"`{field.name}`"].alias(field.name)
            if isinstance(field.dataType, StringType)
            else raw[f"`{field.name}`"].try_cast(field.dataType).alias(field.name)
            for field in schema
        )
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a folder of CSV part files, each with a header line."""
    df.write.mode(mode).option("header", True).csv(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def stage(df: DataFrame, name: str, balance_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Unlike a cache it outlives lost executors, and the readers after it prune
    columns, so one join and clean pass feeds every statistic that follows.
    ``balance_by`` names key columns to spread the rows by first, into partitions
    of a size that Spark picks at run time: worth one shuffle before many passes.
    """
    path = new_folder(df.sparkSession, name)
    if balance_by:
        df = df.hint("rebalance", *balance_by)
    write_parquet(df, path)
    return scan_parquet(df.sparkSession, path)
