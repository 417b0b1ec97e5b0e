"""Session helpers.

Library code never creates its own session; ``get_session`` is only a
convenience for tests, the bench and scripts.  Everything that needs a
reliable location (checkpoints, materialised tables) reads
``spark.checkpoint.dir`` from the running session and only falls back to a
scratch folder when the setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "marketlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used
    as is; the scratch folder is only for local tests.  Sessions without a
    local SparkContext (Spark Connect) manage the folder on the server.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: server-side setting
        return None
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a shared folder for stored tables")
        configured = os.path.join(tempfile.mkdtemp(prefix="marketlens-ckpt-"), "ckpt")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cluster_conf(input_bytes: int, *, target_partition_bytes: int = 256 << 20,
                 broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Settings sized for a cluster job over ``input_bytes`` of input.

    Shuffle partitions are sized so one post-shuffle partition is about
    ``target_partition_bytes`` before AQE coalesces small ones; scans split
    files at the same size; AQE skew handling splits a partition that is 5x
    the median and above 1 GiB.  Pass the result to the session builder.
    """
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.session.timeZone": "UTC",
    }
