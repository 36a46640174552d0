"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Mapping, TypeVar

from pyspark.sql import SparkSession

# Settings that keep plans distributed and adaptive.  They are applied by
# ``local_session`` only; a cluster session keeps whatever its operator chose.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "starloom",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**DEFAULT_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can reach;
    it is read from the session and never replaced.  Only when it is unset in local mode
    (tests) a private folder under the system temp dir is created and registered; on a
    cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local"):
        # local mode only (tests): driver and executors share this machine's temp folder
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                           "(checkpoints and written intermediate tables go there)")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/starloom-{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
                 max_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of source data.

    Shuffles start with enough partitions that each holds about ``target_partition_bytes``
    (at least two per core), AQE then merges small ones and splits skewed ones, and file scans
    read splits of ``max_partition_bytes``.  Apply with ``SparkSession.builder.config(k, v)`` or
    ``spark.conf.set`` before the build.
    """
    shuffle = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
    }


T = TypeVar("T")


def run_concurrently(actions: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent Spark actions from separate threads so their jobs overlap.

    Building a star runs many small jobs (checkpoints, range sampling, size checks) that use
    few tasks each; submitted together they share the executors instead of waiting for each
    other.  Results are the same as running them one after another.
    """
    if len(actions) <= 1:
        return {name: fn() for name, fn in actions.items()}
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = {name: pool.submit(fn) for name, fn in actions.items()}
        return {name: f.result() for name, f in futures.items()}
