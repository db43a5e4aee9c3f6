"""Exact deduplication by a tree merge of sorted digest runs.

Every scan partition makes a run: its digests in order, one row per distinct
text with the smallest id and the number of copies.  Runs are then exchanged
in rounds over the digits of the partition number (base ``fan_in``): in round
r the ``fan_in`` partitions that differ only in digit r swap slices, so each
keeps the digests whose own digit r equals its number's, and merges the
``fan_in`` sorted slices it received (Spark's sort merges them, a streaming
fold keeps one row per text).  After the last round every digest is in one
place.  A text that a third of all rows share is one row per partition from
the first run on, so no task ever gets its copies together.

Equality is decided on the SHA-256 of the normalised text and verified at
every level on its length and a second, independent 64-bit hash; rows whose
digests agree while those differ would stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesift.session import checkpoint_dir

SPACE = r"[\x20\x09-\x0D]+"
KEY = ("sha", "check", "n_bytes")


def normalised(text: Column) -> Column:
    """Text with each run of white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest_columns(text: Column) -> dict[str, Column]:
    norm = normalised(text)
    return {"sha": F.unhex(F.sha2(norm, 256)), "check": F.xxhash64(norm), "n_bytes": F.octet_length(norm).cast("long")}


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in key and id order: the first of each key, with the copies summed."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.table(batch.columns, names=batch.schema.names)
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        rows = rows.combine_chunks()
        new = None
        for name in KEY:
            c = rows[name]
            differs = pc.not_equal(c.slice(1), c.slice(0, rows.num_rows - 1))
            new = differs if new is None else pc.or_(new, differs)
        first = pa.concat_arrays([pa.array([True]), *new.chunks]) if rows.num_rows > 1 else pa.array([True])
        starts = pc.indices_nonzero(first)
        total = pc.cumulative_sum(rows["group_size"]).combine_chunks()
        ends = pc.subtract(pa.concat_arrays([starts.slice(1), pa.array([rows.num_rows], starts.type)]), pa.scalar(1, starts.type))
        upto = total.take(ends)
        sizes = pc.subtract(upto, pa.concat_arrays([pa.array([0], upto.type), upto.slice(0, len(upto) - 1)]))
        kept = rows.take(starts)
        kept = kept.set_column(kept.schema.get_field_index("group_size"), "group_size", sizes)
        held = kept.slice(kept.num_rows - 1)
        if kept.num_rows > 1:
            yield from kept.slice(0, kept.num_rows - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def merge_runs(rows: DataFrame, partitions: int, fan_in: int = 4) -> DataFrame:
    """One row per (sha, check, n_bytes): ``keep_id`` (smallest, nulls last), ``keep_tie``, ``group_size``.

    ``partitions`` is rounded up to a power of ``fan_in``; the number of
    rounds is its logarithm.  Each round moves one row per distinct text and
    partition.
    """
    rounds = 1
    while fan_in**rounds < partitions:
        rounds += 1
    width = fan_in**rounds
    order = [*KEY, F.col("keep_id").asc_nulls_last(), "keep_tie"]
    runs = rows.withColumn("owner", F.pmod(F.spark_partition_id(), F.lit(width)))
    runs = runs.sortWithinPartitions(*order).mapInArrow(_fold, runs.schema)
    # the digits of a digest, from its second half (the first orders the runs)
    place = F.pmod(F.conv(F.substring(F.hex("sha"), 33, 8), 16, 10).cast("long"), F.lit(width))
    for r in range(rounds):
        unit = fan_in**r
        digit = lambda c: F.pmod(F.floor(c / unit), F.lit(fan_in))
        moved = F.col("owner") + (digit(place) - digit(F.col("owner"))) * unit
        runs = runs.withColumn("owner", moved.cast("int"))
        runs = runs.repartitionById(width, F.col("owner"))
        runs = runs.sortWithinPartitions(*order).mapInArrow(_fold, runs.schema)
    return runs.drop("owner")


def _leaf_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(k) for k, c in digest_columns(F.col(text_col)).items()])
    return rows.withColumn("tie", F.monotonically_increasing_id())


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 4) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id stays; of rows that repeat
    both id and text, one.  A null text is an empty one; a null id comes after
    all others.  An empty table gives an empty result; other columns are not
    read.  The digests (no texts) are checkpointed once, so texts are read
    once and the row ties hold when executors are lost.
    """
    spark = docs.sparkSession
    checkpoint_dir(spark)
    rows = _leaf_rows(docs, id_col, text_col).checkpoint()
    leaves = rows.select(*KEY, F.col("doc_id").alias("keep_id"), F.col("tie").alias("keep_tie"), F.lit(1).cast("long").alias("group_size"))
    merged = merge_runs(leaves, int(spark.conf.get("spark.sql.shuffle.partitions")), fan_in)
    groups = merged.where("group_size > 1")  # single texts need no answer
    out = rows.join(groups, list(KEY), "left")
    return out.select(
        "doc_id",
        F.when(F.col("keep_tie").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("keep_tie").isNull() | (F.col("keep_tie") == F.col("tie"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 4) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns, whatever their names."""
    spark = docs.sparkSession
    id_, text = (F.col(f"`{c}`") for c in (id_col, text_col))
    leaves = _leaf_rows(docs.select(id_.alias("doc_id"), text.alias("text")), "doc_id", "text")
    leaves = leaves.select(*KEY, F.col("doc_id").alias("keep_id"), F.col("tie").alias("keep_tie"), F.lit(1).cast("long").alias("group_size"))
    merged = merge_runs(leaves, int(spark.conf.get("spark.sql.shuffle.partitions")), fan_in).select(*KEY, "keep_id")
    # a row is one struct beside the keys, so no column of it can clash with theirs
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, id_.alias("id"), *[c.alias(k) for k, c in digest_columns(text).items()])
    joined = keyed.join(merged, list(KEY)).where(F.col("id").eqNullSafe(F.col("keep_id")))
    # rows that repeat id and text: one of them; the join has them together already
    return joined.dropDuplicates(list(KEY)).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
