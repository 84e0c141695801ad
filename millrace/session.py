"""Session settings and the shared folder for intermediate files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark.

    On a cluster the caller brings a session of its own; nothing in this
    package depends on the values chosen here except the UTC time zone.
    """
    builder = SparkSession.builder.master(f"local[{cores}]").appName("millrace")
    builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    for key, value in {**_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Without that setting it is a folder in the warehouse, which all executors
    share as well.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier call has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def fresh_name(label: str) -> str:
    """A table or view name that no earlier call has used."""
    return f"{label}_{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and continue from there.

    The rows lie there as Parquet, so columns and sizes stay known to the planner.
    """
    path = fresh_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
