"""Spark session settings shared by the jobs, tests and the bench.

Cluster jobs get their session from the platform; ``local_session`` is for
tests and the bench only.  Nothing here overrides a setting the cluster
already made (``spark.checkpoint.dir`` in particular).
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on: UTC dates (so day boundaries match the
# oracle), AQE for runtime coalescing and skew splits, Arrow for the
# grouped-map model fits.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tillwise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings the jobs assume on an existing session."""
    for key, value in JOB_CONF.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static or locked settings stay as the cluster set them
            pass
    ship_package(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local[") or spark.conf.get("spark.master", "") == "local"


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, however the driver found it.

    In local mode they get the driver's folder on their path; on a cluster the
    package goes along as a zip file, once for each application.
    """
    root = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    if is_local(spark):
        path = context.environment.get("PYTHONPATH", "")
        if str(root) not in path.split(os.pathsep):
            context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [str(root), path]))
        return
    if getattr(context, "_tillwise_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="tillwise-"), "tillwise.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(root))
    context.addPyFile(target)
    context._tillwise_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared filesystem folder and
    is used as is.  Only in local mode, where one machine does all work, is a
    fresh scratch folder made when it is missing; a cluster without it is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext on this client
            current = None
    if not current:
        if not is_local(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tillwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        spark.sparkContext.setCheckpointDir(current)
    except Exception:
        pass
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for materialised tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


_TRAINED: dict[tuple, object] = {}


def per_application(spark: SparkSession, key: tuple, build):
    """Memoise ``build()`` for this Spark application (e.g. trained models shared by
    several jobs of one run); a new application trains afresh."""
    full = (spark.conf.get("spark.app.id", None) or id(spark), *key)
    if full not in _TRAINED:
        _TRAINED[full] = build()
    return _TRAINED[full]
