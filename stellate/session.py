"""Session construction and the shared scratch folder.

Scratch data (materialised key assignments, landed files, table stores
created by jobs) lives under the folder the cluster names in
``spark.checkpoint.dir``. A machine-local folder is only created when that
setting is absent, which happens in unit tests.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def recommended_conf(input_bytes: int, total_cores: int, *, target_partition_bytes: int = 256 << 20,
                     broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Settings sized for the data: shuffles start with enough partitions
    for ``target_partition_bytes`` each (AQE then coalesces small ones and
    splits skewed ones), file splits of the same size, and the size limit
    for measured broadcasts. At 100 TB on 1000 x 8 cores this gives about
    400k initial shuffle partitions of 256 MB; at sf0.1 it stays at 2 x cores.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "stellate.broadcast.maxBytes": str(broadcast_bytes),
    }


def build_session(master: str | None = "local[*]", app: str = "stellate",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for scratch tables: ``spark.checkpoint.dir`` when set.

    Only when neither the session conf nor the context names one and Spark
    runs in this process alone (tests), a local folder is created and
    registered as checkpoint dir; executors elsewhere could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="stellate-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused folder under the scratch root."""
    return f"{scratch_root(spark)}/stellate/{tag}-{uuid.uuid4().hex[:12]}"


_COLLECT_EVERY_S = 20
_collected_at = 0.0


def collect_garbage(spark: SparkSession, every: float = _COLLECT_EVERY_S) -> bool:
    """Let go of what finished queries have left: broadcast tables stay in the
    driver, and shuffle files on disk, until the driver's collector finds their
    plans unused, which a heap that still has room does not look for. A full
    collection also gives the heap's spare pages back. Does nothing within
    ``every`` seconds of the last one."""
    global _collected_at
    if time.monotonic() - _collected_at < every:
        return False
    gc.collect()   # plans that Python still holds in cycles
    spark._jvm.System.gc()
    _collected_at = time.monotonic()
    return True
