"""Session helpers: a local session for tests/bench and shared scratch space.

Scratch data (lineage cuts, round-trip files) always lives below the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is absent
(local tests) do we pick a fresh folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from .errors import PipelineError


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "featuremap") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - Spark Connect: only the configuration is visible
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise PipelineError("set spark.checkpoint.dir to a folder that all executors share")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise PipelineError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="featuremap-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"featuremap-{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``featuremap`` importable in the Python workers.

    The Arrow scoring kernel and the workbook data source run in Python
    workers, which must import this package.  When it is not installed on
    the executors, the package is zipped once per application and added with
    ``addPyFile`` (what ``--py-files`` does), so Spark ships it to every
    executor.
    """
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # pragma: no cover - Spark Connect: install the package on the cluster
        return
    if key in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="featuremap-pyfiles-"), "featuremap.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("featuremap", os.path.relpath(full, pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
