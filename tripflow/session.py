"""Session helpers: the settings every job relies on, and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the jobs assume. Time zone is fixed so that epoch and text times
# mean the same wall-clock value on every executor.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app: str = "tripflow", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`JOB_CONF` applied.

    On a cluster the master and resources come from ``spark-submit``; the
    ``master`` argument is for local runs and tests only.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_job_conf(spark)
    return spark


def ensure_job_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for k, v in JOB_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python
    tasks can import it wherever the session was started from."""
    sc = spark.sparkContext
    if getattr(sc, "_tripflow_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # executors fetch the archive from the driver, so it lives as long as the application
    archive = os.path.join(tempfile.mkdtemp(dir=getattr(sc, "_temp_dir", None)), "tripflow_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("tripflow", os.path.relpath(path, package)))
    sc.addPyFile(archive)
    sc._tripflow_shipped = True


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, under the cluster's checkpoint dir.

    ``spark.checkpoint.dir`` (or the context's checkpoint dir) names the shared
    folder on a cluster. Where neither is set, a local master gets a fresh
    temporary folder, registered as the checkpoint dir; any other master is
    refused, since its executors do not see the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base and not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="tripflow-")
        spark.sparkContext.setCheckpointDir(base)
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path


def fresh_dir(spark: SparkSession, kind: str) -> str:
    """A new, unused folder below :func:`shared_dir` for one run."""
    return shared_dir(spark, "tripflow", kind, uuid.uuid4().hex)
