"""What the operators share: tables cut in the shared folder, and column checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowlens.session import new_folder

#: Words of a text, in Java's and Python's syntax alike.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts differ in length by five orders of magnitude, so batches for Python are cut by bytes; and files of a shuffle are
#: dropped when the job that made them ends, as every table that is read again is staged.
SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def stage(df: DataFrame, name: str) -> DataFrame:
    """Run ``df`` now: write it as Parquet in the shared folder and read it back.

    This cuts the lineage, survives lost executors, and is where an operator runs its jobs.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(table: DataFrame) -> None:
    """Remove a table of :func:`stage` that nothing reads any more, to have its room."""
    spark = table.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def two_columns(df: DataFrame, key: str, value: str) -> DataFrame:
    """Only ``key`` and ``value``, as ``id`` long and ``value``: other columns can't clash with the operators' own."""
    return df.select(df[f"`{key}`"].cast("long").alias("id"), df[f"`{value}`"].alias("value"))


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` of a function of one batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (made := make(batch)) is not None:
                yield made

    return df.mapInArrow(run, schema)


def integers(spark: SparkSession, n: int, name: str) -> DataFrame:
    """One row for each integer from 0 to n - 1."""
    return spark.range(n).select(F.col("id").cast("int").alias(name))
