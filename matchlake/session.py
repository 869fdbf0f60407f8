"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for local runs and tests.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}

# Runtime SQL settings for large clusters (~100 TB input, ~1000 executors).
# Applied by ``cluster_session`` only where the cluster left them unset.
#  * Many initial shuffle partitions, coalesced by AQE to ~256 MB each, so a
#    partition fits executor memory at any scale and small stages stay small.
#  * Skew join splitting for partitions 5x the median and above 256 MB (a hot
#    key may hold a third of the rows; partial aggregation covers group-bys).
#  * Broadcast decided at run time from measured shuffle sizes (AQE), capped at
#    64 MB; the static, estimate-based threshold stays at Spark's 10 MB.
#  * 256 MB scan splits keep task counts reasonable on 100 TB scans.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "matchlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("MATCHLAKE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_session(app: str = "matchlake") -> SparkSession:
    """Session on the cluster the launcher configured; fills ``CLUSTER_CONF``
    defaults only where unset, and requires ``spark.checkpoint.dir``."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    apply_defaults(spark, CLUSTER_CONF)
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession, conf: dict[str, str]) -> list[str]:
    """Set each runtime setting nobody set (neither the launch configuration
    nor the session at run time); return the keys set."""
    launch = spark.sparkContext.getConf()
    applied = []
    for k, v in conf.items():
        if not launch.contains(k) and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
            applied.append(k)
    return applied


def _on_cluster(sc) -> bool:
    """Executors outside this process (``local-cluster`` among them)."""
    return not sc.master.startswith("local") or sc.master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only in local mode
    (tests, single-machine runs) is a folder of our own created when it is
    unset; on a cluster a machine-local folder would not be shared, so its
    absence is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if _on_cluster(sc):
            raise RuntimeError("spark.checkpoint.dir is not set: give the cluster a shared "
                               "folder for checkpoints and scratch tables")
        configured = tempfile.mkdtemp(prefix="matchlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared checkpoint folder for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/matchlake-{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``scratch_path`` once no result reads it."""
    if "/matchlake-" not in path:
        raise ValueError(f"{path} is no scratch folder")
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


# Thread-local job properties a concurrent submission must carry over, so its
# jobs stay in the caller's job group (cancellable together), description and
# scheduler pool.
_INHERITED = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel",
              "spark.scheduler.pool")


def run_concurrently(spark: SparkSession, tasks, parallel: int = 4) -> list:
    """Run zero-argument callables that each submit Spark jobs, ``parallel`` at a
    time from driver threads, carrying the caller's job properties; results in
    task order.  Only job submission happens on these threads."""
    from concurrent.futures import ThreadPoolExecutor

    tasks = list(tasks)
    if parallel <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    sc = spark.sparkContext
    props = {k: sc.getLocalProperty(k) for k in _INHERITED}

    def run(task):
        for k, v in props.items():
            if v is not None:
                sc.setLocalProperty(k, v)
        return task()

    with ThreadPoolExecutor(max_workers=min(parallel, len(tasks))) as pool:
        return list(pool.map(run, tasks))
