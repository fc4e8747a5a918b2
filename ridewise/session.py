"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app_name: str = "ridewise", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. The web UI stays off."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting must be present; a machine-local folder would
    not survive the loss of an executor. Only a local session (tests) gets a
    fresh scratch folder when the setting is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL.get(spark.sparkContext.applicationId)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="ridewise-ckpt-", dir="/tmp")
        _LOCAL[spark.sparkContext.applicationId] = d
    spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def drop_scratch(spark: SparkSession) -> int:
    """Deletes the tables, models and stream sinks this process has written to
    the shared folder, through the folder's own store, and returns how many.
    For use once the results that read them have been consumed."""
    hadoop, n = spark._jsc.hadoopConfiguration(), 0
    while _SCRATCH:
        p = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += p.getFileSystem(hadoop).delete(p, True)
    return n


def cut_lineage(df, name: str = "stage"):
    """Materialise ``df`` as a parquet table in the shared folder and read it
    back: one computation (a reliable ``checkpoint()`` of an uncached plan
    computes it twice), lineage cut, and the table survives executor loss.
    Never ``localCheckpoint``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def env_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ridewise`` importable in Python workers (pandas UDFs,
    mapInPandas, applyInPandas*), whatever the driver's working directory:
    the package is zipped once per application and added with
    ``addPyFile`` (the equivalent of ``--py-files``); Spark distributes it."""
    import zipfile
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="ridewise-pkg-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)
