"""Session settings and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Semantics the operators rely on; all are runtime-settable SQL options.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Cluster defaults.  Sizes are targets per task, not counts, so the same values
# hold from one laptop to a thousand executors: AQE merges small shuffle blocks
# up to the advisory size and splits skewed ones.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "lithosense", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults; ``master`` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **_REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on to an existing session."""
    for key, value in _REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``, else
    one below its warehouse.  Driver and executors must all see it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"{warehouse.rstrip('/')}/_scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the scratch root."""
    return f"{scratch_root(spark)}/lithosense/{label}-{uuid.uuid4().hex}"


def materialise(df, label: str):
    """Cut lineage: write ``df`` as Parquet to the shared scratch folder and read it back.

    Unlike a cached block, a written table survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
