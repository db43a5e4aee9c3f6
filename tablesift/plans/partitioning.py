"""Partitioning helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# A scan is spread only when it has at most this many partitions (small
# inputs: a few files or row groups); larger scans keep their own splits, so
# no big table ever pays an extra shuffle for it.
SPREAD_MAX_INPUT_PARTITIONS = 128
# At most this fan-out per input partition.
SPREAD_MAX_FANOUT = 32


def spread(df: DataFrame) -> DataFrame:
    """Round-robin repartition a small scan that cannot keep the cluster
    busy (fewer partitions than the default parallelism), e.g. a table
    stored as one file with a single row group.

    Used before row-multiplying steps (unpivots, substring expansion), where
    one task would otherwise do all the work.  Only scans with at most
    ``SPREAD_MAX_INPUT_PARTITIONS`` partitions qualify, and the new count is
    capped at ``SPREAD_MAX_FANOUT`` times the old one, so large inputs are
    never reshuffled and tiny ones do not turn into thousands of empty tasks.
    """
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    # A one-column projection has the same scan splits and a cheap RDD form.
    n = df.select(F.lit(1)).rdd.getNumPartitions()
    target = min(parallelism, SPREAD_MAX_FANOUT * max(n, 1))
    if n <= SPREAD_MAX_INPUT_PARTITIONS and n < target:
        return df.repartition(target)
    return df


def shared_checkpoint_dir(spark) -> str | None:
    """The checkpoint folder the session names (``spark.checkpoint.dir``),
    installed on the context if only the session conf carries it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named:
            sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute a small frame that a plan reads more than once, once.

    With a shared checkpoint folder (``spark.checkpoint.dir``) the frame is
    checkpointed there, which also cuts its lineage; without one (local
    runs) it is cached and filled at once.  Used for frames of bounded size
    (one row per attribute, candidate lists) and for the levels of
    level-wise searches, which callers release when the next level exists.
    """
    if shared_checkpoint_dir(df.sparkSession) is not None:
        return df.checkpoint()
    cached = df.cache()
    cached.count()  # fill the cache now, like the eager checkpoint
    return cached
