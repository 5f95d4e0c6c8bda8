"""Session defaults and the shared folder in which long plans are cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "rowlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the SQL defaults on a session that somebody else built."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a new local one only on a local master without it."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if context.getCheckpointDir() is None:
        if not configured and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="rowlens-"))
    return configured or context.getCheckpointDir()


_owners: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used. It belongs to the innermost :func:`owned_tables` that is open."""
    path = f"{shared_dir(spark).rstrip('/')}/rowlens/{name}-{uuid.uuid4().hex}"
    if _owners:
        _owners[-1].append(path)
    return path


@contextmanager
def owned_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Removes the staged tables that are made inside it when it ends, also by an error; gives the list of their paths.

    Results that read them must be written or collected inside. Tables made without an owner stay until somebody deletes them.
    """
    paths: list[str] = []
    _owners.append(paths)
    try:
        yield paths
    finally:
        _owners.remove(paths)
        hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        for path in paths:
            folder = hadoop.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
