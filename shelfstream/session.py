"""Session settings and shared-storage helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# Runtime SQL settings every job relies on.  Broadcasts stay size-checked by
# Catalyst (autoBroadcastJoinThreshold); skewed join partitions are split at
# run time, also when the split costs one extra exchange.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure_session(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Where that is unset, as in tests, a folder in the warehouse is used, which executors share as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/working-tables"
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/shelfstream/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts the lineage, survives executor loss, and lets Catalyst see the true
    size: a small result is broadcast by the ordinary threshold, a large one
    is shuffled.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """:func:`materialize` with the row count, taken while the table is written."""
    observed = Observation()
    table = materialize(df.observe(observed, F.count(F.lit(1)).alias("rows")), label)
    return table, observed.get["rows"]
