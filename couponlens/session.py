"""Session helpers: configuration and the shared folder for written tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session should carry. AQE re-plans joins at run time
# (broadcast only below the measured size threshold, skew-join splitting,
# partition coalescing); the UI stays off (no server).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "couponlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster pass no master and let spark-submit decide; locally the
    shuffle partition count should be close to the number of cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for written tables and checkpoints.

    Taken from the session (``spark.checkpoint.dir``). Only a local-mode
    session without one gets a fresh scratch folder; a cluster session
    without one is an error, because a machine-local folder would not
    survive the loss of that machine.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="couponlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    return sc.getCheckpointDir()


def hadoop_path(spark: SparkSession, path: str):
    """(Hadoop path, its file system): any store that Spark reads, not only local files."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def file_status(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of every file under ``path``; empty if it does not exist."""
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    files, out = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return out


def input_bytes(spark: SparkSession, path: str) -> int:
    p, fs = hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength()


#: Shuffle blocks (map tasks x reducers) an exchange may have; the driver tracks them all.
MAX_BLOCKS = 1_000_000_000
#: Most map tasks of a scan; splits grow beyond 256 MB rather than pass it.
MAX_MAPS = 50_000


def scale_conf(input_bytes: int, total_cores: int, shuffled_share: float = 0.05,
               target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Partition settings for a cluster run over ``input_bytes`` of receipts.

    A shuffle here follows column pruning, a window filter or a partial
    aggregation, so it is sized from the bytes that reach it,
    ``shuffled_share`` of the input, at ``target_partition_bytes`` a reducer
    and at least two reducers a core. Scans take 256 MB splits, larger ones
    when that would be more than ``MAX_MAPS`` tasks, and maps x reducers stay
    under ``MAX_BLOCKS``. 100 TB on 8,000 cores: 50,000 maps of 2 GB, 20,000
    reducers, 1e9 blocks. AQE then merges small reducers and splits skewed
    joins around the target size; it does not split aggregates, which is why
    the count has to fit from the start.
    """
    split = max(256 << 20, -(-input_bytes // MAX_MAPS))
    maps = max(1, -(-input_bytes // split))
    wanted = max(2 * total_cores, 200 if input_bytes > 1 << 40 else 8, int(input_bytes * shuffled_share) // target_partition_bytes)
    reducers = min(wanted, MAX_BLOCKS // maps)
    return {
        "spark.sql.shuffle.partitions": str(reducers),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(reducers),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def apply_scale(spark: SparkSession, path: str) -> None:
    """Set ``scale_conf`` of the input at ``path`` on a running session."""
    for key, value in scale_conf(input_bytes(spark, path), spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)
