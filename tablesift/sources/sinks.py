"""Text sinks for IND results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# beside the part files; Spark's readers skip names that begin with an underscore
ORDER_FOLDER = "_order"


def write_lines(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write the ``line`` column as text, sorted, replacing what was there.

    The lines are sorted over ranges, one part file a range, so no task has
    them all; the parts read in the order of their names are the sorted
    lines, and ``line_order`` returns the manifest that says so.
    ``single_file`` writes one part in one task: for results bounded by the
    schema, such as IND lines.  An empty result still replaces an older
    output.
    """
    out = df.select("line").orderBy("line")
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").text(path)
    parts = df.sparkSession.read.text(path).groupBy(F.col("_metadata.file_name").alias("part"))
    parts = parts.agg(F.count("*").alias("n_lines"), F.min("value").alias("first_line"), F.max("value").alias("last_line"))
    parts.orderBy("part").coalesce(1).write.mode("overwrite").json(f"{path}/{ORDER_FOLDER}")


def line_order(spark: SparkSession, path: str) -> DataFrame:
    """One row per part file with lines: part, n_lines, first_line, last_line."""
    return spark.read.schema("part string, n_lines long, first_line string, last_line string").json(f"{path}/{ORDER_FOLDER}")
