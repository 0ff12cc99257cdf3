"""Session helpers for tests, the bench and command-line jobs.

Library code never creates a session; it takes one. ``local_session`` is
for tests and the bench only. ``checkpoint_root`` reads the cluster's
``spark.checkpoint.dir`` and only falls back to a scratch folder when the
setting is absent (local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "histwise") -> SparkSession:
    parts = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local inputs: let AQE keep one partition per core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a scratch one only if unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store); "
                           "a machine-local folder does not survive executor loss")
    path = tempfile.mkdtemp(prefix="histwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder for what a run keeps while it works, in the shared checkpoint folder. Its user may delete
    it once the results are read."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/histwise/{name}-{uuid.uuid4().hex}"


# Partition sizing for cluster runs: every scan split and shuffle partition should hold
# about TARGET_PARTITION_BYTES so it fits in one task's memory share without heavy spill.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
# Above this number of partitions they grow instead: a shuffle has partitions x map tasks blocks.
MAX_PARTITIONS = 40_000
# Shuffled question rows carry the window and item columns: about 3x their parquet size.
SHUFFLE_EXPANSION = 3


def input_bytes(spark: SparkSession, paths) -> int:
    """Total stored size of the input paths (file-system metadata only, no scan)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def sized_conf(n_bytes: int, cores: int) -> dict[str, str]:
    """Settings that keep scan splits and shuffle partitions near the target size.

    The shuffle partition count is an upper bound: AQE coalesces small partitions at
    runtime and splits skewed ones in joins."""
    target = max(TARGET_PARTITION_BYTES, -(-n_bytes * SHUFFLE_EXPANSION // MAX_PARTITIONS))
    parts = max(2 * cores, -(-n_bytes * SHUFFLE_EXPANSION // target))
    size = f"{-(-target // (1024 * 1024))}m"
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{TARGET_PARTITION_BYTES // (1024 * 1024)}m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def apply_sizing(spark: SparkSession, paths, force: bool = False) -> dict[str, str]:
    """Size partitions for the inputs at ``paths``; settings given at launch win
    unless ``force``. Returns what was set."""
    launch = spark.sparkContext.getConf()
    conf = sized_conf(input_bytes(spark, paths), spark.sparkContext.defaultParallelism)
    applied = {k: v for k, v in conf.items() if force or not launch.contains(k)}
    for k, v in applied.items():
        spark.conf.set(k, v)
    return applied
