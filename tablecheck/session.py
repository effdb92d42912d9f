"""Session helpers: shared scratch location and the documented config map.

The library never creates a session for the caller; tests and ``bench.py``
do.  Anything written as an intermediate (round-trip tables, JSON fixtures
derived from a table, streaming checkpoints) goes under the shared folder the
cluster names in ``spark.checkpoint.dir``.  Only a local-mode session without
that setting gets a folder of its own, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# The session settings the validation workload was tuned with.
# AQE on (coalesces the tiny post-aggregation partitions), vectorized Parquet.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.enableVectorizedReader": "true",
    "spark.sql.parquet.columnarReaderBatchSize": "4096",
}


def configure(builder: "SparkSession.Builder", registry_settings=None, **extra: str) -> "SparkSession.Builder":
    """Apply the recommended settings, a registry's ``spark_config`` and
    ``extra`` (dots as ``__``, e.g. ``spark__sql__shuffle__partitions="400"``)
    to a builder; the caller still creates and owns the session."""
    conf = {**RECOMMENDED_CONF, **dict(registry_settings or {}),
            **{k.replace("__", "."): str(v) for k, v in extra.items()}}
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  When
    unset on a local master, a folder is created and set, as tests do; on a
    cluster an unset value is an error, since a machine-local folder would not
    survive the loss of an executor.  Works on Spark Connect through the
    session configuration alone.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no sparkContext
        sc = None
    if sc is not None:
        root = root or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if root and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
    if root:
        return root.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/NFS)")
    root = tempfile.mkdtemp(prefix="tablecheck-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A fresh sub-folder of the checkpoint root for one run of ``name``."""
    root = checkpoint_root(spark)
    # The context appends its own UUID folder to the checkpoint dir; keep
    # our outputs beside it under a fixed prefix.
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{root}/tablecheck/{leaf}"


def local_test_session(app: str = "tablecheck-tests", cores: int | str = "*", **conf: str) -> SparkSession:
    """Local session used by tests and the bench (the library never calls it)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("TABLECHECK_DRIVER_MEMORY", "8g")))
    for k, v in {**RECOMMENDED_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("TABLECHECK_LOG_LEVEL", "FATAL"))
    checkpoint_root(spark)
    return spark
