"""Session construction and the shared scratch location.

Anything the library writes (round-trip files, keyed-table versions, stream
checkpoints) goes under the directory the cluster names in
``spark.checkpoint.dir``. Only when that is unset (tests, a laptop) do we pick
one ourselves and register it with the session, so later calls agree.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Session with the settings the plans are written for.

    AQE stays on: it coalesces the small post-aggregation shuffles and splits
    skewed join partitions at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        # wide aggregates (the profile) keep whole-stage codegen
        "spark.sql.codegen.maxFields": "1000",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory of this session (set one if unset)."""
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - older API
            root = None
    if not root:
        # Unset: only in tests / single-machine use. Register it so every
        # later call (and RDD checkpointing) uses the same place.
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set(_CHECKPOINT_KEY, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
