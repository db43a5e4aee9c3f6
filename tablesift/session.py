"""Spark session setup.

The library never creates a session on its own: every operator takes a
``SparkSession`` or ``DataFrame``.  ``build_session`` is a convenience for
tests, the bench and command-line use; on a cluster the caller's session (and
its ``spark.checkpoint.dir``) is used as is.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours gets.  AQE re-plans joins and coalesces or
# splits shuffle partitions at run time, which is what keeps the fixed
# ``shuffle.partitions`` value from mattering much at scale.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "tablesift",
    shuffle_partitions: int | None = 8,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the library defaults.

    ``shuffle_partitions`` plays the role of the reference's ``--partitions``
    switch and ``master`` the role of ``--cores`` (``local[N]``).
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be there (a path of a shared file system):
    without it this is an error, as executors could not read each other's
    files.  In ``local[...]`` mode a folder is installed where it is unset:
    ``fallback`` if given, else a fresh one under the system temp dir.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    # the setting is fixed once a session runs; the context remembers the folder instead
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(fallback or tempfile.mkdtemp(prefix="tablesift-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def scale_conf(
    input_bytes: int,
    cores: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
    max_split_bytes: int = 256 * 1024 * 1024,
    max_tasks: int = 65_536,
) -> dict[str, str]:
    """Settings sized for an input of ``input_bytes`` on ``cores`` cores.

    * ``spark.sql.shuffle.partitions``: enough that the largest shuffle (the
      value-grouping one, about the size of the scanned columns before
      partial aggregation) lands at ``target_partition_bytes`` per partition,
      and at least two waves of the cluster's cores.  AQE then coalesces
      small partitions and splits skewed ones.
    * ``spark.sql.files.maxPartitionBytes``: scan splits of at most
      ``max_split_bytes`` (row groups permitting).
    * AQE advisory size equal to the target, so coalescing and the initial
      count agree.

    A shuffle has a block for each pair of a map task and a reducer, and the
    driver keeps track of them, so neither side gets more than ``max_tasks``
    (or two waves of the cores, if that is more): beyond it, partitions and
    splits grow with the input.
    """
    most = max(2 * cores, max_tasks)
    shuffle = max(2 * cores, min(most, -(-input_bytes // target_partition_bytes)))
    partition = max(target_partition_bytes, -(-input_bytes // most))
    split = max(max_split_bytes, -(-input_bytes // most))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
