"""Session helpers: building a local session for tests/bench, the shared
checkpoint directory every operator relies on, and settings for a cluster."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes (turns
# shuffle joins into broadcast joins when a side turns out small, splits skewed
# partitions, coalesces tiny ones). UTC keeps date arithmetic engine-neutral.
_SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # PySpark 4 records a Python call site in the JVM for every DataFrame /
    # functions call (error context). Wide plans make thousands of such calls
    # on the driver; turning it off removes a JVM round trip per call.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoint files of a DataFrame that is no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # the attributes table is 161 columns wide; above the default 100 fields
    # whole-stage codegen is switched off for those stages
    "spark.sql.codegen.maxFields": "400",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "winback", driver_memory: str = "16g") -> SparkSession:
    """Session for tests and the bench (``local[cores]``)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in _SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local-mode session with no
    setting gets a private temporary folder (tests); on a cluster an unset
    directory is an error, because a machine-local folder would not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="winback-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path that a later session finds again: under the folder that
    ``spark.checkpoint.dir`` names (Spark itself uses a new subfolder of it for each
    session), or in a session without that setting under its checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def cluster_conf(input_bytes: int, total_cores: int,
                 partition_bytes: int = 256 * 1024 ** 2) -> dict:
    """Settings sized for a cluster run over ``input_bytes`` of Parquet.

    * scan splits of ``partition_bytes`` (256 MB) so a task's input fits in
      executor memory with room for decompression;
    * shuffle partitions from the data size, at least two waves of cores;
      AQE coalesces them down where stages turn out smaller, and splits
      skewed join partitions (a key holding a third of the rows) into
      advisory-sized pieces;
    * runtime bloom filters let a selective join side prune the large side
      before its shuffle (transactions vs. the customer xref, web orders);
    * broadcast only below 64 MB, by the size Spark knows or measures.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        # let a selective side up to 256 MB build the filter (default 10 MB);
        # checked to fire on the transaction x xref, web-order and address
        # joins, pruning the fact side before its shuffle. Filter capped at
        # 32 MB (50M items).
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(256 * 1024 ** 2),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(50_000_000),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(256 * 1024 ** 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.session.timeZone": "UTC",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.codegen.maxFields": "400",
    }
