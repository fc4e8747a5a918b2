"""Sources and sinks: typed CSV scans, table/metrics writers, model
persistence, cached loads.

CSV is read with an explicit schema (no inference pass over the data);
date columns are parsed by the schema. Writers go to a path the caller
chooses (on a cluster, a shared folder).
"""

from __future__ import annotations

import json

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewise.operators.anomaly import Network, leaf_lengths


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             date_format: str = "yyyy-MM-dd", timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
             keep_none_string: bool = True) -> DataFrame:
    """A1 / A2: header CSV with a fixed schema. ``keep_none_string`` keeps
    the literal value ``none`` (a category, not a null)."""
    r = (spark.read.schema(schema).option("header", header).option("dateFormat", date_format)
              .option("timestampFormat", timestamp_format).option("mode", "FAILFAST"))
    if keep_none_string:
        r = r.option("nullValue", "")
    return r.csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """A3: write a table (csv with a header, parquet or json), no index column."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A4: a (small) metrics table as JSON lines in one file."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    """MLlib pipelines (feature list included in the assembler stage)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_forest(spark: SparkSession, forest: dict, path: str) -> None:
    """A6 for the isolation forest: one row per tree, plus the sample size."""
    rows = [(i, t[0].tolist(), t[1].tolist(), t[2].tolist(), t[3].tolist(), t[4].tolist())
            for i, t in enumerate(forest["trees"])]
    df = spark.createDataFrame(rows, "tree int, feat array<int>, thr array<double>, left array<int>, "
                                     "right array<int>, size array<int>")
    meta = json.dumps({"psi": forest["psi"], "features": forest["features"]})
    df.withColumn("meta", F.lit(meta)).write.mode("overwrite").parquet(path)


def load_forest(spark: SparkSession, path: str) -> dict:
    rows = spark.read.parquet(path).orderBy("tree").collect()
    meta = json.loads(rows[0]["meta"])
    trees = [(np.array(r["feat"], dtype=np.int32), np.array(r["thr"]), np.array(r["left"], dtype=np.int32),
              np.array(r["right"], dtype=np.int32), np.array(r["size"], dtype=np.int32)) for r in rows]
    return {"trees": trees, "leaf": leaf_lengths(trees), "psi": meta["psi"], "features": meta["features"]}


def save_network(spark: SparkSession, network: Network, path: str) -> None:
    """A6 for the autoencoder: one row per layer."""
    rows = [(i, list(m.shape), m.ravel().tolist(), c.tolist()) for i, (m, c) in enumerate(network.layers)]
    spark.createDataFrame(rows, "layer int, shape array<int>, weights array<double>, bias array<double>") \
         .write.mode("overwrite").parquet(path)


def load_network(spark: SparkSession, path: str) -> Network:
    rows = spark.read.parquet(path).orderBy("layer").collect()
    return Network([(np.array(r["weights"]).reshape(r["shape"]), np.array(r["bias"])) for r in rows])


def cached(df: DataFrame) -> DataFrame:
    """Keep a base table that several aggregates read (memory and disk,
    so a lost block is recomputed rather than failing)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
