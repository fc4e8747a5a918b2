"""Parquet table access and size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# A dimension is broadcast only when the optimizer's size estimate is below this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; Catalyst prunes columns and pushes filters to the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of a plan (no job is run)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - connect sessions have no JVM handle
        return -1


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise leave the choice to
    Catalyst/AQE (sort-merge or shuffled-hash join, runtime re-plan)."""
    size = estimated_bytes(df)
    if 0 <= size <= limit:
        return F.broadcast(df)
    return df
