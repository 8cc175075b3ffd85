"""SparkSession construction from a small YAML/dict config.

Every key of the config is honoured (the notebooks this library replaces read
only four of them).  The Spark UI is always off: nothing here opens a port
beyond what a Spark session opens by itself.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession

# Config key -> Spark conf key.  Values are passed through str().
_CONF_KEYS = {
    "driver_memory": "spark.driver.memory",
    "executor_memory": "spark.executor.memory",
    "executor_cores": "spark.executor.cores",
    "num_executors": "spark.executor.instances",
    "shuffle_partitions": "spark.sql.shuffle.partitions",
    "adaptive_enabled": "spark.sql.adaptive.enabled",
    "coalesce_partitions": "spark.sql.adaptive.coalescePartitions.enabled",
    "skew_join": "spark.sql.adaptive.skewJoin.enabled",
    "serializer": "spark.serializer",
    "parquet_compression": "spark.sql.parquet.compression.codec",
    "parquet_merge_schema": "spark.sql.parquet.mergeSchema",
    "memory_fraction": "spark.memory.fraction",
    "storage_fraction": "spark.memory.storageFraction",
    "broadcast_threshold": "spark.sql.autoBroadcastJoinThreshold",
    "max_partition_bytes": "spark.sql.files.maxPartitionBytes",
    "checkpoint_dir": "spark.checkpoint.dir",
    "event_log_dir": "spark.eventLog.dir",
}

DEFAULTS: dict[str, Any] = {
    "adaptive_enabled": True,
    "coalesce_partitions": True,
    "skew_join": True,
    "serializer": "org.apache.spark.serializer.KryoSerializer",
    "parquet_compression": "snappy",
    "parquet_merge_schema": False,
    "spark.sql.execution.arrow.pyspark.enabled": True,
}


def load_config(path: str) -> dict[str, Any]:
    """Read a YAML config; nested sections are flattened (last key wins)."""
    import yaml

    with open(path, encoding="utf-8") as fh:
        raw = yaml.safe_load(fh) or {}
    flat: dict[str, Any] = {}

    def walk(node: Any) -> None:
        if isinstance(node, Mapping):
            for k, v in node.items():
                if isinstance(v, Mapping):
                    walk(v)
                else:
                    flat[str(k)] = v

    walk(raw)
    return flat


def spark_conf_from_config(cfg: Mapping[str, Any] | None) -> dict[str, str]:
    merged = dict(DEFAULTS)
    merged.update(cfg or {})
    out: dict[str, str] = {}
    for key, value in merged.items():
        conf_key = _CONF_KEYS.get(key)
        if conf_key is None and key.startswith("spark."):
            conf_key = key
        if conf_key is None or value is None:
            continue
        out[conf_key] = str(value).lower() if isinstance(value, bool) else str(value)
    if "spark.eventLog.dir" in out:
        out["spark.eventLog.enabled"] = "true"
    out["spark.ui.enabled"] = "false"
    out.setdefault("spark.sql.session.timeZone", "UTC")
    return out


def build_session(
    cfg: Mapping[str, Any] | None = None,
    master: str | None = None,
    app_name: str = "event_ml",
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in spark_conf_from_config(cfg).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only a local master may leave it unset; a fresh scratch folder is
    made then.  Executors elsewhere could not see such a folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="event_ml-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
