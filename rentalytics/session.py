"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job needs regardless of cluster size.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpointed intermediates (rank and quantile tables) are deleted from the
    # shared checkpoint folder once their DataFrames are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def scaled_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of Parquet on ``total_cores`` cores.

    Scan splits and post-shuffle partitions aim at ``target_partition_bytes``
    (256 MB: a task's working set stays well inside an executor core's memory
    share and spills gracefully); the initial shuffle partition count covers
    the input at that size, rounded up to whole waves of the cluster's cores,
    and AQE coalesces or splits from there (skewed partitions above 4x the
    median and 1 GB are split).
    """
    waves = -(-max(1, input_bytes // target_partition_bytes) // max(1, total_cores))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(max(total_cores, waves * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL settings, except those the platform set at launch (those win)."""
    launched = dict(spark.sparkContext.getConf().getAll())
    for k, v in conf.items():
        if k not in launched:
            spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rentalytics") -> SparkSession:
    """Local session for tests and benches (the cluster provides its own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it: by path where executors see the
    driver's files (local modes), else as an archive that Spark sends them, once per application."""
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.master.startswith("local"):
        paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p and p != root]
        sc.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    elif sc.applicationId not in _SHIPPED:
        import shutil
        with_name = os.path.join(tempfile.mkdtemp(prefix="rentalytics-"), "rentalytics")
        sc.addPyFile(shutil.make_archive(with_name, "zip", root, "rentalytics"))
        _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the platform and is only read
    here.  A local folder is set only when nothing is configured (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="rentalytics-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for materialised intermediates."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


def materialise(df):
    """Cut the lineage of a small intermediate that several jobs read (a range
    partitioner's sample, running sums, the final aggregate): a reliable
    checkpoint in the shared ``spark.checkpoint.dir``, so its upstream runs
    once and a lost executor does not re-run it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise_table(df, name: str = "table"):
    """Cut the lineage of a *wide* intermediate that many plans read by writing it as Parquet in the
    shared checkpoint folder and reading it back.  Unlike ``checkpoint()`` (read back as whole rows),
    later reads prune to the columns they use and push their filters into the scan."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)
