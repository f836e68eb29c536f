"""Session helpers: a local session for tests/bench and the shared work folder.

Every table the library writes lives under the folder the cluster names in
``spark.checkpoint.dir``.  It is read from the session; only when it is unset
(plain local runs, tests) does :func:`work_root` create one and register it as
the checkpoint directory, so lineage cuts and table files share one root.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_root: str | None = None


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "tablewright",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the local bench (UI off, UTC, AQE on); ``extra`` adds configs."""
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get(_CHECKPOINT_KEY, None)
    if value:
        return value
    try:
        return spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    except Exception:  # Spark Connect has no SparkContext
        return None


def work_root(spark: SparkSession) -> str:
    """Shared folder for table files: ``<spark.checkpoint.dir>/tablewright``."""
    global _local_root
    configured = _configured_checkpoint_dir(spark)
    if configured:
        return configured.rstrip("/") + "/tablewright"
    if _local_root is None:
        # Only a local-mode run may fall back to a machine-local folder; on a
        # cluster every executor must see the same files.
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (tables and checkpoints go there)")
        _local_root = tempfile.mkdtemp(prefix="tablewright-")
        spark.sparkContext.setCheckpointDir(_local_root + "/checkpoints")
    return _local_root + "/tablewright"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under :func:`work_root`."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def unique_table_name(label: str) -> str:
    return f"tw_{label}_{uuid.uuid4().hex[:10]}"
