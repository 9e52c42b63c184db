"""Session construction for tests and benchmarks, and the shared working folder.

Library functions never build a session; they receive one (or a DataFrame). This module
is only used by tests, ``bench.py`` and the command-line helpers.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours carries. Instants are handled in UTC so that
# date_format/datediff agree across machines, AQE re-plans joins and coalesces
# shuffle partitions at runtime, and skewed join partitions are split.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Call-site capture for error messages costs a JVM round trip per DataFrame call on
    # the driver; batch jobs do not need it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    app: str = "spark_marts",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A ``local[cores]`` session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The cluster names that directory in ``spark.checkpoint.dir``; we read it from the
    session. Only a local-mode session (tests) without one gets a private temporary
    folder, because a machine-local path is meaningless to remote executors.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="spark-marts-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "stage"):
    """Compute ``df`` once and cut its lineage by writing it to the shared checkpoint folder.

    Used where one derived frame feeds several branches of a plan. Exchange reuse cannot
    be relied on there: column pruning gives each branch a different subplan, so the
    upstream (scans, joins, aggregations) would otherwise run once per branch. A written
    Parquet table is produced by a single job (``Dataset.checkpoint`` would run the plan
    twice, once to count and once to save), carries real file sizes for AQE's broadcast
    decisions, and survives lost executors because it lives in shared storage.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20, max_partitions: int | None = None) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume.

    Shuffle partitions start at about one per ``target_partition_bytes`` of input (and
    at least two per core) so no reducer has to hold more than it can spill, and end at
    ``max_partitions`` where given, as a shuffle keeps a block size for each pair of tasks on the driver; beyond
    that partitions grow and spill. AQE then coalesces small partitions and splits skewed ones. Broadcasts stay behind a size
    threshold checked at runtime. Pass the result to ``SparkSession.builder.config``.
    """
    partitions = max(2 * total_cores, min(max_partitions or input_bytes, -(-input_bytes // target_partition_bytes)))
    target = f"{target_partition_bytes >> 20}m"
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": target,
        "spark.sql.files.maxPartitionBytes": target,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": target,
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.sources.bucketing.autoBucketedScan.enabled": "true",
    }
